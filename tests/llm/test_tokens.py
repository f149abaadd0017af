"""SentencePiece and token files against their libraries."""

import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from barlab.llm import registry, sentencepiece_codec, token_files

ODD = [
    "", " ", "   ", "▁", "a▁b ▁ c", " lead", "trail ", "two  spaces   three", "tab\tand\nline\r\n", "ﬁ Å é ́x", "\x00nul",
    "🙂🙂 \U0010ffff", "İSTANBUL ſ ŉ ß ẞ Σ ΑΣ", "<s> </s> <unk> <0x41>", "<|endoftext|> <|ENDOFTEXT|> <|startoftext|>a",
    "it's I'LL we'd 'tis y'all've", "a b c\x1cd\x85e", "½ ² 12345 ١٢٣", "日本語 テキスト", "ÀÉÎÕÜ àéîõü ŒUVRE", "--..!!''s't",
    "é ́ क़", "x" * 3_000, "word " * 3_000,
]


def made_up(seed):
    rng = random.Random(seed)
    letters = "abcdeéßñ ABCÉ  '.,!\n\t0129%$▁🙂ıİĳſ́"
    return ["".join(rng.choices(letters, k=rng.randint(0, 120))) for _ in range(150)]


@pytest.fixture(scope="module")
def texts():
    return ODD + made_up(1)


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


def test_pieces_equal_the_library(docs, texts, monkeypatch):
    library = sentencepiece.SentencePieceProcessor(model_file=registry.PIECE_MODEL)
    rows = {r.doc_id: r for r in sentencepiece_codec.encode_decode(docs, registry.PIECE_MODEL).collect()}
    for i, text in enumerate(texts):
        ids = library.encode(text)
        assert rows[i].ids == ids, text
        assert rows[i].decoded == (library.decode(ids) if ids else ""), text


def test_a_word_table_may_be_dropped_at_any_time(texts, monkeypatch):
    monkeypatch.setattr(sentencepiece_codec, "TABLE_WORDS", 3)
    words = sentencepiece_codec.MarkedWords(registry.PIECE_MODEL)
    assert words.by_word
    for text in texts:
        (ids, decoded), = words.encode([text])
        assert np.frombuffer(ids, dtype=np.int32).tolist() == words.pieces.encode(text)


def test_a_task_of_many_words_takes_bounded_memory():
    words = sentencepiece_codec.marked_words(registry.PIECE_MODEL)
    texts = [" ".join(f"w{i}" for i in range(k, k + 2_000)) for k in range(0, 300_000, 2_000)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["__text"])
    tracemalloc.start()
    try:
        n = sum(b.num_rows for b in sentencepiece_codec.encoded(iter([batch]), registry.PIECE_MODEL, ["ids", "decoded"]))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n == len(texts) and not words.known
    assert peak < 40e6, peak


def test_encode_then_decode(docs, odd, nothing):
    ids = sentencepiece_codec.encode(docs, registry.PIECE_MODEL)
    back = sentencepiece_codec.decode(ids.drop("text"), registry.PIECE_MODEL)
    plain = docs.where(~F.col("text").contains("▁"))
    assert back.join(plain.withColumnRenamed("text", "was"), "doc_id").where("text <> was").count() == 0
    found = sentencepiece_codec.encode_decode(odd, registry.PIECE_MODEL)
    assert found.columns == [*[c for c in odd.columns if c != "ids"], "ids", "decoded"]
    assert found.count() == odd.count()
    assert found.where("text is null and (size(ids) <> 0 or decoded <> '')").count() == 0
    assert sentencepiece_codec.encode_decode(nothing, registry.PIECE_MODEL).count() == 0


@pytest.mark.parametrize("partitions", [None, 5])
def test_token_store_round_trip(spark, tmp_path, docs, texts, partitions):
    path = str(tmp_path / "store")
    token_files.write_tokens(docs.orderBy(F.desc("doc_id")), path, registry.WORD_VOCABULARY, end_id=1, partitions=partitions)
    library = Tokenizer.from_file(registry.WORD_VOCABULARY)
    stored = {r.doc_id: r for r in token_files.read_tokens(spark, path).collect()}
    sums = {r.doc_id: r for r in token_files.with_checksums(token_files.read_tokens(spark, path)).collect()}
    start = 0
    for i, text in enumerate(texts):
        ids = [*library.encode(text, add_special_tokens=False).ids, 1]
        assert stored[i].tokens == ids, text
        assert (stored[i].start, stored[i].n_tokens) == (start, len(ids))
        assert sums[i].ids_crc32 == zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        start += len(ids)


def test_the_fast_way_meets_a_full_table(texts, monkeypatch):
    monkeypatch.setattr(token_files, "TABLE_WORDS", 2)
    ids = token_files.WordIds(registry.WORD_VOCABULARY)
    assert ids.plain
    for text in texts:
        assert np.frombuffer(ids.encode([text])[0], dtype="<u4").tolist() == ids.whole.encode(text, add_special_tokens=False).ids


def test_encodings_and_selective_reads(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    path = str(tmp_path / "store")
    token_files.write_tokens(docs, path, registry.WORD_VOCABULARY, end_id=1, partitions=3)
    file = next((tmp_path / "store" / "tokens").glob("part-*.parquet"))
    group = pq.ParquetFile(file).metadata.row_group(0)
    columns = {group.column(i).path_in_schema.split(".")[0]: group.column(i) for i in range(group.num_columns)}
    assert any("DICTIONARY" in e for e in columns["tokens"].encodings)
    assert any("DELTA" in e for e in columns["local_start"].encodings)
    assert columns["tokens"].has_offset_index and columns["doc_id"].has_column_index
    narrow = token_files.read_tokens(spark, path).select("doc_id", "start")._jdf.queryExecution().executedPlan().toString()
    assert "tokens" not in narrow.split("ReadSchema")[1].split("\n")[0]
    some = token_files.read_tokens(spark, path).where("doc_id between 10 and 12")
    assert "GreaterThanOrEqual(doc_id,10)" in some._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.doc_id for r in some.collect()) == [10, 11, 12]


def test_odd_rows_in_a_store(spark, tmp_path, odd, nothing):
    token_files.write_tokens(odd, str(tmp_path / "odd"), registry.WORD_VOCABULARY, end_id=1)
    rows = token_files.read_tokens(spark, str(tmp_path / "odd")).collect()
    assert len(rows) == odd.count()
    starts = sorted((r.start, r.n_tokens) for r in rows)
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))
    assert [r.doc_id for r in sorted(rows, key=lambda r: (r.start, r.n_tokens))][:2] == [None, None]
    token_files.write_tokens(nothing, str(tmp_path / "none"), registry.WORD_VOCABULARY, end_id=1)
    assert token_files.with_checksums(token_files.read_tokens(spark, str(tmp_path / "none"))).count() == 0
