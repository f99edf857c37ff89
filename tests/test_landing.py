"""CSV files land by header name; nothing is put into a wrong field
and nothing is lost."""
import gzip

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from starledger.contracts import DIM_LOCATION, DIM_TRANSACTION_TYPE, FACT_TRANSACTIONS
from starledger.sources.landing import HeaderError, land
from starledger.sources.layers import land_csv

TS = "2024-01-01T00:00:00Z"


def put(folder, name, text):
    import os
    os.makedirs(folder, exist_ok=True)
    data = text.encode()
    with open(f"{folder}/{name}", "wb") as f:
        f.write(gzip.compress(data) if name.endswith(".gz") else data)


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


COLS = ("location_key", "city", "governorate", "country")


def test_each_file_is_read_by_its_own_header(spark, scratch):
    put(scratch, "a.csv", "location_key,city,governorate,country\n1,Cairo,Greater Cairo,Egypt\n")
    put(scratch, "b.csv", "city,location_key,country,governorate\nGiza,2,Egypt,Greater Cairo\n")
    put(scratch, "c.csv", '﻿country, governorate ,location_key,city\nEgypt,"Upper, South",3,Aswan\n')
    put(scratch, "d.csv.gz", "\ncity,location_key,country,governorate\nLuxor,4,Egypt,Upper\n")
    put(scratch, "e.csv", "")
    put(scratch, "_SUCCESS", "not,a,table\n")
    df = land_csv(spark, scratch, DIM_LOCATION, TS)
    assert rows(df, *COLS) == [("1", "Cairo", "Greater Cairo", "Egypt"), ("2", "Giza", "Greater Cairo", "Egypt"),
                               ("3", "Aswan", "Upper, South", "Egypt"), ("4", "Luxor", "Upper", "Egypt")]
    assert rows(df, "_source_file", "_ingested_at_utc") == [(f, TS) for f in ("a.csv", "b.csv", "c.csv", "d.csv.gz")]


def test_extra_columns_are_kept_by_name(spark, scratch):
    put(scratch, "a.csv", "note,city,location_key,country,governorate,zip\nhello,Giza,2,Egypt,GC,\n")
    landed = land(spark, scratch, DIM_LOCATION, TS)
    r = landed.rows.collect()
    assert rows(landed.rows, *COLS) == [("2", "Giza", "GC", "Egypt")] and r[0]["_extra"] == {"note": "hello", "zip": None}
    assert landed.layouts[0].unexpected == ("note", "zip") and landed.layouts[0].missing == ()


def test_missing_columns(spark, scratch):
    nullable = [c for c in FACT_TRANSACTIONS.names if c not in ("merchant_key", "ach_transfer_id")]
    put(f"{scratch}/f", "a.csv", ",".join(nullable) + "\n" + ",".join(str(i) for i in range(len(nullable))) + "\n")
    landed = land(spark, f"{scratch}/f", FACT_TRANSACTIONS, TS)
    r = landed.rows.collect()[0]
    assert r["merchant_key"] is None and all(r[c] == str(i) for i, c in enumerate(nullable))
    assert landed.layouts[0].missing == ("merchant_key", "ach_transfer_id")
    put(f"{scratch}/g", "a.csv", "city,governorate,country\nGiza,GC,Egypt\n")
    with pytest.raises(HeaderError, match="no column location_key"):
        land(spark, f"{scratch}/g", DIM_LOCATION, TS)
    assert rows(land(spark, f"{scratch}/g", DIM_LOCATION, TS, strict=False).rows, "city", "location_key") == [("Giza", None)]
    put(f"{scratch}/h", "a.csv", "city,city,location_key,governorate,country\nGiza,Luxor,1,GC,Egypt\n")
    with pytest.raises(HeaderError, match="column city twice"):
        land(spark, f"{scratch}/h", DIM_LOCATION, TS)


def test_records_of_the_wrong_width_are_dead_letters(spark, scratch):
    put(scratch, "a.csv", "city,location_key,country,governorate\nGiza,2,Egypt\nLuxor,4,Egypt,Upper,more\n"
                          'Aswan,3,Egypt,"Up""per"\n,,,\nNA,5,null,None\n')
    landed = land(spark, scratch, DIM_LOCATION, TS)
    assert rows(landed.dead_letters, "raw_record", "error", "_source_file") == [
        ("Giza,2,Egypt", "wrong_number_of_fields", "a.csv"), ("Luxor,4,Egypt,Upper,more", "wrong_number_of_fields", "a.csv")]
    got = {tuple(r[c] for c in COLS) for r in landed.rows.collect()}
    assert got == {("3", "Aswan", 'Up"per', "Egypt"), (None, None, None, None), ("5", "NA", "None", "null")}
    # columns that a reader doesn't ask for don't change which records are whole
    assert landed.rows.select("city").count() == 3 and landed.dead_letters.select("error").count() == 2


def test_quoted_line_breaks(spark, scratch):
    put(scratch, "a.csv", 'city,location_key,country,governorate\n"Al\nGiza",2,Egypt,GC\n')
    assert rows(land(spark, scratch, DIM_LOCATION, TS, multi_line=True).rows, "city") == [("Al\nGiza",)]
    assert rows(land(spark, scratch, DIM_LOCATION, TS).dead_letters, "raw_record") == [('"Al',)]


def test_no_files(spark, scratch):
    landed = land(spark, f"{scratch}/none", DIM_LOCATION, TS)
    assert landed.rows.count() == 0 and landed.dead_letters.count() == 0 and landed.layouts == []
    assert landed.rows.columns == [*COLS, "_extra", "_ingested_at_utc", "_source_file"]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.permutations(DIM_TRANSACTION_TYPE.names + ["x"]),
       st.lists(st.lists(st.text("ab ,\"", max_size=4), min_size=4, max_size=4), min_size=1, max_size=5))
def test_any_order_of_columns(spark, header, values):
    import csv
    import io
    import tempfile
    folder = tempfile.mkdtemp(prefix="starledger-land-")
    text = io.StringIO()
    out = csv.writer(text, lineterminator="\n")
    out.writerow(header)
    out.writerows(values)
    put(folder, "t.csv", text.getvalue())
    got = rows(land(spark, folder, DIM_TRANSACTION_TYPE, TS, strict=False).rows.fillna("", DIM_TRANSACTION_TYPE.names),
               *DIM_TRANSACTION_TYPE.names)
    assert got == sorted(tuple(dict(zip(header, v, strict=True))[c] for c in DIM_TRANSACTION_TYPE.names) for v in values)
