import pytest

from martflow.llm import tokens as T
from martflow.llm.queries import QUERIES, public_tokenizer

MODEL = public_tokenizer("piece_bpe_32k.model")


def counts(texts, path=MODEL):
    if path.endswith(".model"):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        return [len(sp.encode(t)) for t in texts]
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    return [len(t.encode(x, add_special_tokens=False).ids) for x in texts]


def test_query_against_the_library(spark, sf_small):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    rows = QUERIES["op1_token_counts"](spark, sf_small).collect()
    want = dict(zip(docs, counts(docs.values())))
    assert len(rows) == len(docs)
    for r in rows:
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].encode()), want[r.doc_id], want[r.doc_id] > 4096)


TEXTS = [None, "", " ", "a", "</s> <s> <unk>", "é\n\t ü", "x" * 50_000, "word " * 5000, "a", None]


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "byte_bpe_50k.json"])
def test_odd_texts(spark, name):
    path = public_tokenizer(name)
    df = spark.createDataFrame([(i % 9, t, b"x", "v") for i, t in enumerate(TEXTS)], "doc_id long, text string, content binary, tokenizer string")
    got = sorted((r.doc_id, r.n_tokens, r.over_limit) for r in T.token_counts(df, T.Tokenizer(path)).collect())
    assert got == sorted((i % 9, n, n > 4096) for i, n in enumerate(counts([t or "" for t in TEXTS], path)))
    assert T.token_counts(df.limit(0), T.Tokenizer(path)).count() == 0


def test_only_distinct_misses_are_encoded(spark, docs_of, tmp_path):
    cache, tok = str(tmp_path / "cache"), T.Tokenizer(MODEL)
    T.token_counts(docs_of(["one", "two", "one", None]), tok, cache).collect()
    assert T.read_cache(spark, cache, tok.version).count() == 3 == spark.read.parquet(cache).count()
    rows = T.token_counts(docs_of(["one", "three", "", "three"]), tok, cache).collect()
    assert len(rows) == 4 and spark.read.parquet(cache).count() == 4
    other = T.Tokenizer(public_tokenizer("byte_bpe_50k.json"))
    assert other.version != tok.version
    T.token_counts(docs_of(["one"]), other, cache).collect()
    assert spark.read.parquet(cache).count() == 5


def test_stored_counts_are_used(spark, docs_of, tmp_path):
    cache, tok = str(tmp_path / "cache"), T.Tokenizer(MODEL)
    import hashlib
    spark.createDataFrame([(bytearray(hashlib.sha256(b"one").digest()), tok.version, 4242)] * 2, T.CACHE).write.parquet(cache)
    assert {r.doc_id: r.n_tokens for r in T.token_counts(docs_of(["one"]), tok, cache).collect()} == {0: 4242}


def test_unknown_file(tmp_path):
    (tmp_path / "x.bin").write_bytes(b"")
    with pytest.raises(ValueError):
        T.Tokenizer(str(tmp_path / "x.bin"))
