"""One text of over two million characters, with what there is to find at its very end."""

import hashlib
import re

import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from barlab.llm import decontamination, license_scan, license_templates, line_dedup, pii, quality_rules, registry, secret_scan, sentencepiece_codec, simhash, token_files
from tests.llm.test_dedup import plain_fingerprint

PASSAGE = "\n".join(" ".join(f"shared{i}y{w}" for w in range(30)) for i in range(3))
ITEM = "the quick brown fox jumps over the lazy dog while twelve monkeys watch"


@pytest.fixture(scope="module")
def text():
    body = "\n".join(f"line{i} " + " ".join(f"wörd{(i * 7919 + w * 31) % 9973}" for w in range(12)) for i in range(20_000))
    found = f"{body}\n{PASSAGE}\n{license_templates.TEMPLATES['mit-line']}\n{ITEM} password = s3cretS3cret mail jane.doe@example.org"
    assert len(found) > 2_000_000
    return found


@pytest.fixture(scope="module")
def docs(spark, text):
    rows = [(1, f"before\n{PASSAGE}\nafter it all"), (2, text), (3, text)]
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def row(df, i=2):
    return df.where(F.col("doc_id") == i).collect()[0]


def test_scans(docs, text):
    at = text.rindex("password")
    assert f"assign:{at}:{at + len('password = s3cretS3cret')}" in row(secret_scan.secret_report(docs)).spans
    at = text.rindex("jane")
    assert f"email:{at}:{len(text)}" in row(pii.personal_report(docs)).spans
    found = license_scan.scan_licenses(docs, license_templates.TEMPLATES).where("doc_id = 2 and license = 'mit-line'").collect()
    assert [(r.start, r.coverage) for r in found] == [(text.rindex(license_templates.TEMPLATES["mit-line"]), 1.0)]


def test_filters(spark, docs, text):
    items = spark.createDataFrame([(7, ITEM)], "item_id bigint, text string")
    hit = row(decontamination.decontaminate(docs, items))
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())
    assert (hit.n_words, hit.n_hit, hit.items) == (len(words), len(ITEM.split()), ["7"])
    counts = row(quality_rules.quality_verdicts(docs))
    assert counts.n_words == len(text.split()) and counts.word_chars == sum(map(len, text.split()))
    prints = row(simhash.near_duplicates(docs), 3)
    assert (prints.fingerprint, prints.component_id) == (f"{plain_fingerprint(text):016x}", 2)
    cleaned = line_dedup.dedup_passages(docs)
    assert row(cleaned).text == text.replace(PASSAGE + "\n", "") and row(cleaned, 3).text == ""


def test_tokens(docs, text, tmp_path, spark):
    pieces = sentencepiece.SentencePieceProcessor(model_file=registry.PIECE_MODEL)
    found = row(sentencepiece_codec.encode_decode(docs, registry.PIECE_MODEL))
    assert found.ids == pieces.encode(text) and found.decoded == pieces.decode(found.ids)
    library = Tokenizer.from_file(registry.WORD_VOCABULARY)
    token_files.write_tokens(docs, str(tmp_path / "t"), registry.WORD_VOCABULARY, 1)
    ids = row(token_files.read_tokens(spark, str(tmp_path / "t"))).tokens
    assert hashlib.sha256(str(ids).encode()).hexdigest() == hashlib.sha256(str([*library.encode(text, add_special_tokens=False).ids, 1]).encode()).hexdigest()
