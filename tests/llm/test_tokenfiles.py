import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from helpers import MEDIUM, ODD, docs_of, texts
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from starledger.llm.common import shared_path, table, utf8_buffers
from starledger.llm.tokenfiles import END_ID, Encoder, read_tokens, token_index, tokenize, write_tokens

PATH = public_tokenizers.path("word_bpe_49k.json")
DIRECT = Tokenizer.from_file(PATH)


def ids_of(text):
    return DIRECT.encode(text or "", add_special_tokens=False).ids


ENCODER = Encoder(PATH)


def encoded(rows):
    lengths, ids = ENCODER.encode(*utf8_buffers(pa.array(rows, pa.large_string())))
    return [x.tolist() for x in np.split(ids, np.cumsum(lengths)[:-1])]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("aAbZ'stre \n\t\r.,!|<#́̌İKéΣß\x01\x1c 你12"), max_size=30),
                min_size=1, max_size=6))
def test_chunks_give_the_ids_of_whole_texts(rows):
    assert encoded(rows) == [ids_of(t) for t in rows]


def test_special_strings_and_long_chunks():
    rows = ["a<|endoftext|>b", "x|y<z", "Q" * 5000, "it's  don't", "\x01", ""]
    assert encoded(rows) == [ids_of(t) for t in rows]


def expected(rows):
    out, start = [], 0
    for d, t in rows:
        ids = np.array([*ids_of(t), END_ID], "<u4")
        out.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_round_trip_over_the_whole_table(spark):
    got = tokenize(table(spark, MEDIUM, "documents"), PATH).orderBy("doc_id").collect()
    assert [tuple(r)[:4] for r in got] == expected(texts(MEDIUM))


def test_odd_rows(spark):
    rows = [r for r in ODD]
    got = tokenize(docs_of(spark, rows), PATH).orderBy("start").collect()
    order = sorted(((r[0], r[1]) for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    assert [tuple(r)[:4] for r in got] == expected(order)
    assert tokenize(docs_of(spark, rows).limit(0), PATH).count() == 0


def test_files_are_in_id_order_and_prune_by_id(spark):
    path = shared_path(spark, "test-tokens")
    write_tokens(table(spark, MEDIUM, "documents").repartition(7), path, PATH)
    index = token_index(spark, path).orderBy("start").collect()
    assert [r["doc_id"] for r in index] == sorted(r["doc_id"] for r in index)
    one = read_tokens(spark, path).where("doc_id = 321")
    assert "EqualTo(doc_id,321)" in one._jdf.queryExecution().toString()
    assert one.first()["ids"] == [*ids_of(dict(texts(MEDIUM))[321]), END_ID]


def test_files_hold_bloom_filters(spark):
    path = shared_path(spark, "test-bloom")
    write_tokens(table(spark, MEDIUM, "documents"), path, PATH)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(path)
    files = [f.getPath() for f in folder.getFileSystem(conf).listStatus(folder) if f.getPath().getName().endswith(".orc")]
    reader = jvm.org.apache.orc.OrcFile.createReader(files[0], jvm.org.apache.orc.OrcFile.readerOptions(conf))
    assert reader.getRowIndexStride() == 10000
    footer = reader.rows().readStripeFooter(reader.getStripes().get(0))
    kinds = [(footer.getStreams(i).getKind().toString(), footer.getStreams(i).getColumn())
             for i in range(footer.getStreamsCount())]
    assert ("ROW_INDEX", 1) in kinds and ("BLOOM_FILTER_UTF8", 1) in kinds       # column 1 is doc_id


@pytest.mark.parametrize("n", [1, 5])
def test_partitioning_does_not_matter(spark, n):
    docs = docs_of(spark, [(i, f"Text number {i} of all.") for i in range(50)]).repartition(n)
    got = [tuple(r)[:4] for r in tokenize(docs, PATH).orderBy("start").collect()]
    assert got == expected([(i, f"Text number {i} of all.") for i in range(50)])
