"""BPE against the tokenizers library, piece by piece and over whole tables."""

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lumenframe.llm import bpe
from lumenframe.llm.queries import QUERIES

from ..conftest import SF

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.load(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids(library, texts):
    return [bpe.pack(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_every_code_point(vocabulary, library):
    texts = [f"a{c}1 {c}{c} .{c}b" for c in map(chr, range(0x3100)) if not 0xD800 <= ord(c) < 0xE000]
    texts += [f"a{chr(c)}1 {chr(c)}" for c in range(0x3100, 0x110000, 97) if not 0xD800 <= c < 0xE000]
    assert [vocabulary.encode(t) for t in texts] == ids(library, texts)


def test_random_texts_and_special_strings(vocabulary, library):
    rng = random.Random(5)
    parts = ["the", " ", "  ", "\n", "\t", "'s", "'ll", "x1", "Zürich", "日本", "<|endoftext|>", "<|end", "...", " ", "aaaa", "😀"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(40))) for _ in range(3000)]
    texts += ["", "<|endoftext|>", "<|endoftext|><|endoftext|> a", " " * 100, "ab" * 5000]
    mine = [vocabulary.encode(t) for t in texts]
    assert mine == ids(library, texts)
    assert [vocabulary.decode(m).decode() for m in mine] == texts


def test_blocks_change_no_id(vocabulary, library, monkeypatch):
    rng = random.Random(6)
    monkeypatch.setattr(bpe, "BLOCK", 50)
    monkeypatch.setattr(bpe, "_block", bpe.regex.compile(r"(?s).{0,50}\s*\S+|\s+"))
    texts = ["".join(rng.choices(["word", " ", "\n\n", "12", "!?", "é"], k=400)) for _ in range(200)] + [" " * 300, "x" * 300, "y" * 90 + " " * 90]
    assert all("".join(bpe.blocks(t)) == t for t in texts)
    assert [vocabulary.encode(t) for t in texts] == ids(library, texts)


def test_memory_is_bounded(vocabulary, monkeypatch):
    monkeypatch.setattr(bpe, "MEMORY", 10)
    vocabulary.known.clear()
    text = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200))
    first = vocabulary.encode(text)
    assert len(vocabulary.known) <= 10 and vocabulary.encode(text) == first


def test_decoding_parts_of_characters(vocabulary, library):
    whole = library.encode("日本語 😀", add_special_tokens=False).ids
    for cut in range(len(whole) + 1):
        for part in (whole[:cut], whole[cut:], whole[::-1][:cut]):
            assert vocabulary.decode(bpe.pack(part)).decode() == library.decode(part, skip_special_tokens=False)
    assert vocabulary.decode(bpe.pack([64, 4_000_000_000, 65])).decode() == library.decode([64, 65])


def test_rows_of_all_kinds(spark, vocabulary, library):
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "x"), (4, "long " * 100_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"ids": F.lit(1), "_in": F.lit("x"), "_c0": F.lit(2)})
    coded = bpe.encode(docs, vocabulary, docs.columns, out="codes")
    assert coded.columns == [*docs.columns, "codes"]
    back = bpe.decode(coded, vocabulary, coded.columns, "codes", "again").withColumn("n", bpe.count("codes")).collect()
    want = dict(zip([r[1] or "" for r in rows], ids(library, [r[1] or "" for r in rows])))
    assert len(back) == len(rows)
    assert all(r.again == (r.text or "") and bytes(r.codes) == want[r.text or ""] and 4 * r.n == len(r.codes) for r in back)
    assert bpe.encode(docs.limit(0), vocabulary, ["doc_id"]).count() == 0


def test_whole_table(spark, library):
    import hashlib

    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op12_bpe_round_trip"](spark, SF).collect():
        found = library.encode(docs[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(found), hashlib.sha256(bpe.pack(found)).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library.decode(found, skip_special_tokens=False).encode()).hexdigest()


def test_other_forms_raise():
    with pytest.raises(ValueError):
        bpe.load(public_tokenizers.path("word_bpe_49k.json"))
