"""Q9-Q18: the raw validation report."""
from pyspark.sql import functions as F

from starledger import contracts as C
from starledger.operators import rawreport as RR


def text(spark, contract, rows, extra=()):
    names = [*contract.names, *extra]
    return spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))


LOC = [("1", "Cairo", "GC", "Egypt"), ("2", "Giza", "GC", "Egypt")]
DATES = [("20240101", "2024-01-01", "1", "1", "1", "2024", "0")]


def accounts(*rows):
    """(key, location, date, currency) as account rows."""
    return [(k, f"ACC{k}", loc, cur, None, None, d, "Standard", "Active") for k, loc, d, cur in rows]


def report(spark, acc, **kw):
    tables = {"dim_location": text(spark, C.DIM_LOCATION, LOC), "dim_date": text(spark, C.DIM_DATE, DATES),
              "dim_account": acc}
    contracts = {n: C.STAR[n] for n in tables}
    return RR.validate_raw(tables, contracts, **kw)


def found(r, table="dim_account"):
    return {(x["check_name"], x["column_name"]): (x["violations"], list(x["examples"])) for x in r.rows
            if x["table_name"] == table and x["severity"] != "info"}


def test_clean_tables_pass(spark):
    r = report(spark, text(spark, C.DIM_ACCOUNT, accounts(("1", "1", "20240101", "EGP"), ("2", "+02", " 20240101", "EGP"))))
    assert r.passed and found(r) == {} and [x["violations"] for x in r.rows if x["table_name"] == "dim_account"] == [2]


def test_every_kind_of_violation(spark):
    rows = accounts(("1", "1", "20240101", "EGP"), ("1", "9", "20240101", "EGP"), ("1", "9", "20240101", "EGPX"),
                    ("", "x", "20240101", "EGP"), ("7", None, "20240199", "EGP"), ("99999999999", "2", "20240101", "EGP"))
    r = report(spark, text(spark, C.DIM_ACCOUNT, rows))
    assert r.status == {"dim_location": "PASS", "dim_date": "PASS", "dim_account": "FAIL"} and not r.passed
    assert found(r) == {
        ("primary_key_duplicate", "account_key"): (2, ["1"]), ("primary_key_null", "account_key"): (1, [": "]),
        ("not_null", "account_key"): (1, [": "]), ("not_null", "location_key"): (1, ["7: "]),
        ("foreign_key_null", "location_key"): (1, ["7: "]), ("foreign_key_orphan", "location_key"): (3, ["9", "x"]),
        ("foreign_key_orphan", "signup_date_key"): (1, ["20240199"]), ("exact_length", "currency"): (1, ["1: EGPX"]),
        ("integer_parse", "location_key"): (1, [": x"]), ("integer_range", "account_key"): (1, ["99999999999: 99999999999"])}


def test_examples_are_the_first_of_many(spark):
    rows = accounts(*[(str(i), "1", "20240101", "US") for i in range(100, 150)])
    r = report(spark, text(spark, C.DIM_ACCOUNT, rows))
    assert found(r) == {("exact_length", "currency"): (50, [f"{i}: US" for i in range(100, 105)])}
    r = report(spark, text(spark, C.DIM_ACCOUNT, rows), n=2)
    assert found(r)[("exact_length", "currency")] == (50, ["100: US", "101: US"])


def test_headers(spark):
    acc = text(spark, C.DIM_ACCOUNT, [(*accounts(("1", "1", "20240101", "EGP"))[0], "77")], extra=["transaction_sk"])
    r = report(spark, acc)
    assert r.passed and found(r) == {("header_tolerated", "transaction_sk"): (1, [])}
    r = report(spark, acc.drop("currency").withColumnRenamed("transaction_sk", "odd"))
    assert r.status["dim_account"] == "FAIL"
    assert found(r) == {("header_missing", "currency"): (1, []), ("header_unexpected", "odd"): (1, [])}


def test_missing_and_empty_tables(spark):
    r = RR.validate_raw({"dim_location": text(spark, C.DIM_LOCATION, LOC).limit(0)}, {n: C.STAR[n] for n in ("dim_location", "dim_date")})
    assert r.status == {"dim_location": "PASS", "dim_date": "FAIL"} and r.rows[0]["violations"] == 0


def test_a_check_is_dealt_into_shares_and_the_rules_scan_once(spark, scratch):
    path = f"{scratch}/loc"
    text(spark, C.DIM_LOCATION, LOC).write.parquet(path)
    p = RR.table_report("dim_location", spark.read.parquet(path), C.DIM_LOCATION, {})._jdf.queryExecution().executedPlan().toString()
    # the rules, the key column, the number of rows
    assert p.count("FileScan") == 3 and p.count("country:string") == 1 and "SinglePartition" not in p.split("HashAggregate(keys=[], functions=[count(1)")[0]
    assert "hashpartitioning(check_name" in p and "pmod(xxhash64(example" in p


def odd_typed():
    """One column of each typed kind, nullable, and values on both sides of every rule."""
    ints = ["7", "-7", "+7", " 7 ", "7\n", "007", "99", "100", "255", "256", "-1", "9999", "32767", "32768", "-32768", "-32769", "999999999",
            "2147483647", "2147483648", "-2147483648", "-2147483649", "9223372036854775807", "9223372036854775808", "99999999999999999999999999999999999999999",
            "", None, " ", "x", "1|2", "|", "1.5", "\u0661", "--1"]
    bits = ["0", "1", "", None, "2", "01", " 1", "1\n", "0|1"]
    dates = ["2024-01-28", "2024-02-29", "2023-02-29", "2024-04-31", "2024-12-31", "0000-01-01", "0001-01-01", "2024-13-01", "2024-00-10", "2024-1-1",
             "2024-01-01\n", "", None, "2024-01-01|", "x"]
    decimals = ["1.00", "-1.00", "+1.00", "1.0", "1", ".50", "0000000000000000000001.00", "9999999999999999.99", "99999999999999999.99",
                "-9999999999999999.99", "-99999999999999999.99", "1.00\n", "", None, "1|.00", "N/A"]
    kinds = {"tinyint": ints, "smallint": ints, "int": ints, "bigint": ints, "bit": bits, "date": dates, "decimal(18,2)": decimals}
    cols = tuple(C.Col(f"c{i}", C.STR, wt) for i, wt in enumerate(kinds))
    contract = C.TableContract("odd", (C.Col("id", C.STR, "varchar(9)", False), *cols), primary_key=("id",))
    plain = ["1", "1", "1", "1", "1", "2024-01-01", "1.00"]
    rows = [(f"r{i}.{j}", *plain[:i], v, *plain[i + 1:]) for i, vs in enumerate(kinds.values()) for j, v in enumerate(vs)]
    return contract, [*rows, ("all", *["x|x"] * 7), ("none", *[None] * 7), ("blank", *[""] * 7), ("", *plain), (None, *plain), ("0123456789", *plain)]


def test_no_row_that_breaks_a_rule_passes_as_plain(spark):
    contract, rows = odd_typed()
    df = text(spark, contract, rows)
    broken = None
    for r in RR.row_rules(contract):
        broken = r.violation if broken is None else broken | F.coalesce(r.violation, F.lit(False))
    bad = {r.id for r in df.where(broken).collect()}
    suspects = {r.id for r in RR._suspects(df, contract).collect()}
    assert bad <= suspects and {"", None, "0123456789", "all"} <= bad and len(bad) > 50
    assert not {"none", "blank", "r2.0", "r2.1", "r5.0", "r6.0", "r6.1"} & suspects       # the usual forms cost one pattern
    # the counts are those of the rules, one by one
    got = {(r["check_name"], r["column_name"]): r["violations"] for r in RR.table_report("odd", df, contract, {}).collect()
           if r["severity"] == "error" and r["check_name"] != "primary_key_duplicate"}
    each = [(r.check, r.column, df.where(F.coalesce(r.violation, F.lit(False))).count()) for r in RR.row_rules(contract)]
    assert got == {(c, k): n for c, k, n in each if n}


def test_costly_rules_run_on_suspects_only(spark):
    p = RR._broken_rows(text(spark, C.DIM_DATE, DATES), C.DIM_DATE)._jdf.queryExecution().optimizedPlan().toString()
    kept = [line for line in p.splitlines() if "Filter" in line]
    assert len(kept) == 1 and kept[0].count("RLIKE") == 1 and "decimal(38,0)" not in kept[0]


def test_orphans_of_large_parents_are_counted_before_they_move(spark):
    rows = accounts(("1", "+01", "20240101", "EGP"), ("2", "7", "020240101", "EGP"), ("3", "007", "20240102", "EGP"), ("4", "-7", " ", "EGP"))
    want = {("foreign_key_orphan", "location_key"): (3, ["-7", "7"]), ("foreign_key_orphan", "signup_date_key"): (1, ["20240102"])}
    key, before = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for limit in ("-1", "10m"):
            spark.conf.set(key, limit)
            got = found(report(spark, text(spark, C.DIM_ACCOUNT, rows)))
            assert {k: v for k, v in got.items() if k[0] == "foreign_key_orphan"} == want
    finally:
        spark.conf.set(key, before)
