"""Gold star for the catalog: reload once per driver folder, then read.

``reload_gold`` (S16/S17) writes all eight tables into a new store version,
gates them against their contracts (Q23) and only then publishes the commit.
``star_tables`` returns the committed tables of a driver folder, reloading
when the input files changed (fingerprint of names, sizes, mtimes).  The
store lives under the session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import contracts as C
from ..functions.keys import month_key
from ..operators import quality
from ..operators.surrogate import positions
from ..session import build_session, work_path
from ..sources import fs
from ..sources.store import CommitConflict, Partitioned, VersionedStore
from .adapter import Star

ADAPTER_VERSION = "adapter-1"
STAR_INPUTS = ("lineitem", "orders", "customer", "supplier", "nation", "region")

_MEMO: dict[tuple, tuple[str, dict[str, DataFrame]]] = {}
FACT_PARTITION = "date_month"


def _write_dim(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


SK = {"column": "transaction_sk", "pid": "_sk_pid", "pos": "_sk_pos", "start": 1}


def gold_fact(star_fact: DataFrame) -> DataFrame:
    """Fact rows tagged with their position in transaction_id order; the
    store turns (partition, position) into contiguous ``transaction_sk`` values
    from per-partition counts of the written files (no extra pass over the
    fact).  ``assign_surrogate`` is the stand-alone form of the same keys."""
    return positions(star_fact, "transaction_id", pid=SK["pid"], pos=SK["pos"]) \
        .withColumn(SK["column"], F.lit(None).cast("bigint"))


def reload_gold(spark: SparkSession, tables: dict[str, DataFrame], store: VersionedStore,
                meta: dict | None = None, gate: bool = True) -> int:
    """Atomic full reload of all star tables (all-or-nothing)."""
    frames = dict(tables)
    # month folders let an upsert rewrite only the months it touches
    fact = gold_fact(tables["fact_transactions"]).withColumn(FACT_PARTITION, month_key("date_key"))
    frames["fact_transactions"] = Partitioned(fact, FACT_PARTITION, None, ("date_key", "transaction_id"), dict(SK),
                                              bloom=C.FACT_LOOKUPS)
    writers = {name: _write_dim for name in frames if name != "fact_transactions"}

    def check(written: dict[str, DataFrame]) -> None:
        if gate:
            quality.assert_contracts(written, C.STAR)

    return store.commit(frames, meta=meta, writers=writers, check=check)


def _code_digest(extra=()) -> str:
    """Digest of the modules that define the star, so a code change rebuilds."""
    from .. import contracts
    from ..functions import exact, keys
    from ..operators import dedupe, dims, surrogate
    from . import adapter
    h = hashlib.sha1()
    for mod in (contracts, exact, keys, dedupe, dims, surrogate, adapter, *extra):
        with open(mod.__file__, "rb") as f:
            h.update(f.read())
    with open(__file__, "rb") as f:
        h.update(f.read())
    return h.hexdigest()


def fingerprint(spark: SparkSession, sf_dir: str, inputs=STAR_INPUTS, extra_modules=()) -> str:
    info = []
    for t in inputs:
        info.extend(fs.file_info(spark, f"{sf_dir.rstrip('/')}/{t}.parquet"))
    return hashlib.sha1(json.dumps([ADAPTER_VERSION, _code_digest(extra_modules), info]).encode()).hexdigest()


def _store(spark: SparkSession, kind: str, sf_dir: str) -> VersionedStore:
    key = hashlib.sha1(f"{ADAPTER_VERSION}|{sf_dir.rstrip('/')}".encode()).hexdigest()[:16]
    return VersionedStore(spark, work_path(spark, f"starledger-{kind}", key))


def gold_store(spark: SparkSession, sf_dir: str) -> VersionedStore:
    return _store(spark, "gold", sf_dir)


def _materialized(spark: SparkSession, sf_dir: str, kind: str, inputs, modules, build) -> dict[str, DataFrame]:
    """Tables derived from a driver folder, written once per (inputs, code)
    fingerprint into a versioned store under ``spark.checkpoint.dir``."""
    fp = fingerprint(spark, sf_dir, inputs, modules)
    memo_key = (id(spark), kind, sf_dir.rstrip("/"))
    hit = _MEMO.get(memo_key)
    if hit and hit[0] == fp:
        return dict(hit[1])
    store = _store(spark, kind, sf_dir)
    if store.manifest()["meta"].get("fingerprint") != fp:
        try:
            build(store, {"fingerprint": fp, "source": sf_dir})
        except CommitConflict:
            # another session published the same inputs first: use its version
            if store.manifest()["meta"].get("fingerprint") != fp:
                raise
    tables = store.tables()
    _MEMO[memo_key] = (fp, tables)
    return dict(tables)


def _own_session(spark: SparkSession, sf_dir: str, inputs) -> SparkSession:
    size = sum(n for t in inputs for _, n, _ in fs.file_info(spark, f"{sf_dir.rstrip('/')}/{t}.parquet"))
    return build_session(spark, size)


def star_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The gold star of a driver folder (S16 reload on first use)."""
    def build(store, meta):
        own = _own_session(spark, sf_dir, STAR_INPUTS)
        reload_gold(own, Star(own, sf_dir).tables(), VersionedStore(own, store.root), meta)

    return _materialized(spark, sf_dir, "gold", STAR_INPUTS, (), build)


LAYER_INPUTS = ("lineitem", "orders")


def _layer(spark: SparkSession, sf_dir: str, name: str, make) -> DataFrame:
    """A layer's table, made by ``make`` (session -> frame) on first use."""
    from ..operators import conform
    from . import fixtures

    def build(store, meta):
        own = _own_session(spark, sf_dir, LAYER_INPUTS)
        VersionedStore(own, store.root).commit({name: make(own)}, meta=meta)

    return _materialized(spark, sf_dir, name, LAYER_INPUTS, (conform, fixtures), build)[name]


def bronze_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-string events (S1-S3 form) of a driver folder."""
    from . import fixtures
    return _layer(spark, sf_dir, "bronze_events", lambda own: fixtures.dirty_plan(own, sf_dir))


def silver_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conformed events (P1-P5) of a driver folder, made from the written bronze layer."""
    from . import fixtures

    def make(own: SparkSession) -> DataFrame:
        bronze_events(spark, sf_dir)
        written = VersionedStore(own, _store(spark, "bronze_events", sf_dir).root)
        return fixtures.conform_events(written.read("bronze_events"))

    return _layer(spark, sf_dir, "silver_events", make)


def layer_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Both event layers, each written once like the reference's layers, when first asked for."""
    return {"bronze_events": bronze_events(spark, sf_dir), "silver_events": silver_events(spark, sf_dir)}
