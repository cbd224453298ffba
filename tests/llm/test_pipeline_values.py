"""Each stage of the pipeline by value on a small table, and on an empty one."""

import hashlib
import random
import re

import pytest

import corpus_pipeline
from tradewatch.llm import bpe, mixing, near_dups, quality, secrets

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(6)
    texts = [prose(rng, 60) for _ in range(30)]
    near = texts[3].split()
    near[30] = "changed"
    texts += [texts[0], " ".join(near), "too short", prose(rng, 40) + " password=abcdef12!x9 end of it", None, ""]
    rows = [(i, t, "en", "a" if i % 3 else "b", None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS).cache(), texts


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is None, r[:2]))


def test_quality_stage_keeps_what_the_query_keeps(corpus):
    docs, texts = corpus
    kept = {r["doc_id"] for r in quality.document_quality(docs).where("kept").collect()}
    got = rows_of(quality.kept_documents(docs))
    assert {r[0] for r in got} == kept and {32, 34, 35}.isdisjoint(kept) and len(kept) >= 30
    assert all(r[1] == texts[r[0]] for r in got)


def test_one_document_of_each_group_stays(corpus):
    docs, texts = corpus

    def shingles(text):
        words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")]
        return {tuple(words[k : k + 5]) for k in range(len(words) - 4)} or ({tuple(words)} if words else set())

    sets, stays = [shingles(t) for t in texts], []
    for i, own in enumerate(sets):
        if not own or not any(100 * len(own & sets[j]) >= 80 * len(own | sets[j]) for j in range(i) if sets[j]):
            stays.append(i)
    assert [r[0] for r in rows_of(near_dups.distinct_documents(docs, width=5, percent=80))] == stays
    assert 30 not in stays and 31 not in stays


def test_secret_stage_masks_found_spans_only(corpus):
    docs, texts = corpus
    model = secrets.fit(docs)
    for doc_id, text, *_, chars in rows_of(secrets.masked_documents(docs)):
        (base, extra), = secrets.find([(texts[doc_id] or "").encode()], model)
        want = None if texts[doc_id] is None else secrets.masked(texts[doc_id].encode(), base + extra).decode()
        assert text == want and chars == (None if text is None else len(text))
        assert base or text == texts[doc_id], "a text without secrets is left alone"


def test_mixing_stage_takes_what_the_query_takes(corpus):
    docs, texts = corpus
    taken = {r["doc_id"]: r["taken"] for r in mixing.mixture(docs).collect()}
    words = dict.fromkeys(taken, 0)
    for doc_id, text, *_ in rows_of(mixing.training_stream(docs)):
        words[doc_id] += len(WORD.findall(text or ""))
        assert texts[doc_id].startswith(text)
    for source in "ab":
        own = [i for i in taken if (i % 3 == 0) == (source == "b")]
        assert abs(sum(words[i] for i in own) - sum(taken[i] for i in own)) <= 60, source


def test_encoding_stage_equals_the_codec(corpus):
    docs, texts = corpus
    codec = bpe.Codec(bpe.vocabulary_file())
    for r in bpe.document_tokens(docs).collect():
        ids = codec.encode((texts[r["doc_id"]] or "").encode()).tolist()
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())


def test_stages_of_an_empty_table(spark):
    empty = spark.createDataFrame([], DOCS)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, "")
        assert out.count() == 0, name
        if name != "bpe_encode":
            assert out.columns == empty.columns, name
