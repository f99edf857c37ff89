"""Landing of CSV files by header name.

Every file's own header says where its columns are.  The headers (one small
read per file, side by side) group the files by layout; each layout is one
untyped scan whose columns are then picked by name.  So files of one table may
order their columns differently, lack some or bring others.

A record with more or fewer fields than its file's header is not guessed at: it
goes to the dead letters with its raw text.
"""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import TableContract
from . import fs

RAW = "_raw_record"
WRONG_WIDTH = "wrong_number_of_fields"


class HeaderError(ValueError):
    """A header that the contract's required columns can't be taken from."""


@dataclass(frozen=True)
class Layout:
    """Files with one header, and how it differs from the contract (Q9)."""
    header: tuple[str, ...]
    files: tuple[str, ...]
    missing: tuple[str, ...]
    unexpected: tuple[str, ...]
    repeated: tuple[str, ...]


@dataclass
class Landed:
    #: contract columns (strings), _extra (other columns by name, NULL without any), lineage
    rows: DataFrame
    #: raw_record, error, lineage
    dead_letters: DataFrame
    layouts: list[Layout]


def header_of(spark: SparkSession, path: str) -> tuple[str, ...] | None:
    """Column names of one file; None when it holds no line."""
    line = fs.first_line(spark, path)
    if line is None:
        return None
    return tuple(name.strip() for name in next(csv.reader([line.removeprefix("﻿")])))


def layouts(spark: SparkSession, path: str, contract: TableContract, threads: int = 16) -> list[Layout]:
    """The files under ``path`` (a file, a folder or a glob), by header."""
    files = fs.data_files(spark, path)
    with ThreadPoolExecutor(max_workers=threads) as pool:
        headers = list(pool.map(lambda f: header_of(spark, f), files))
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, header in zip(files, headers, strict=True):
        if header is not None:
            groups.setdefault(header, []).append(file)
    return [Layout(h, tuple(names), tuple(c for c in contract.names if c not in h),
                   tuple(dict.fromkeys(c for c in h if c not in contract.names)),
                   tuple(dict.fromkeys(c for c in h if h.count(c) > 1)))
            for h, names in sorted(groups.items())]


def _check(layout: Layout, contract: TableContract) -> None:
    missing = [c for c in layout.missing if c in contract.required]
    twice = [c for c in layout.repeated if c in contract.names]
    if missing or twice:
        what = "; ".join([*(f"no column {c}" for c in missing), *(f"column {c} twice" for c in twice)])
        raise HeaderError(f"{contract.name}: {what} in {layout.files[0]}"
                          + (f" and {len(layout.files) - 1} more files" if len(layout.files) > 1 else ""))


def _scan(spark: SparkSession, layout: Layout, contract: TableContract, multi_line: bool) -> DataFrame:
    by_place = [f"_f{i}" for i in range(len(layout.header))]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*by_place, RAW]])
    df = (spark.read.schema(schema).options(header=True, nullValue="", emptyValue="", escape='"', mode="PERMISSIVE",
                                            columnNameOfCorruptRecord=RAW, multiLine=multi_line)
          .csv(list(layout.files)))
    place = {}
    for name, field in zip(layout.header, by_place, strict=True):
        place.setdefault(name, field)
    null = F.lit(None).cast("string")
    others = [v for c in layout.unexpected for v in (F.lit(c), F.col(place[c]))]
    extra = F.create_map(*others) if others else F.lit(None).cast("map<string,string>")
    # the reader sees that a record's width is wrong only if it has to read every field
    raw = F.when(F.col(RAW).isNotNull() & F.coalesce(RAW, *by_place).isNotNull(), F.col(RAW))
    return df.select(*[(F.col(place[c]) if c in place else null).alias(c) for c in contract.names], extra.alias("_extra"),
                     raw.alias(RAW), F.col("_metadata.file_name").alias("_source_file"))


def land(spark: SparkSession, path: str, contract: TableContract, run_ts: str, *, strict: bool = True,
         multi_line: bool = False) -> Landed:
    """Land the CSV files under ``path``: strings only, only an empty field is
    NULL (X19), one run timestamp, the source file's name.

    A nullable column that a file lacks is NULL in its rows; a required one, or
    a contracted name that stands twice, raises ``HeaderError`` unless
    ``strict`` is off (then NULL, and the first of the two).  ``multi_line``
    reads line breaks inside quotes, at the price of one task per file; without
    it such a break ends the record, whose first part is a dead letter."""
    found = layouts(spark, path, contract)
    if strict:
        for layout in found:
            _check(layout, contract)
    parts = [_scan(spark, layout, contract, multi_line) for layout in found]
    if parts:
        df = parts[0]
        for p in parts[1:]:
            df = df.unionByName(p)
    else:
        names = [T.StructField(c, T.StringType()) for c in contract.names]
        df = spark.createDataFrame([], T.StructType([
            *names, T.StructField("_extra", T.MapType(T.StringType(), T.StringType())), T.StructField(RAW, T.StringType()),
            T.StructField("_source_file", T.StringType())]))
    at = F.lit(run_ts).alias("_ingested_at_utc")
    rows = df.where(F.col(RAW).isNull()).select(*contract.names, "_extra", at, "_source_file")
    dead = df.where(F.col(RAW).isNotNull()).select(F.col(RAW).alias("raw_record"), F.lit(WRONG_WIDTH).alias("error"), at,
                                                   "_source_file")
    return Landed(rows, dead, found)
