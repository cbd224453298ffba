"""Operators for training text against brute force, and their edge cases on small tables."""

import base64
import gzip
import hashlib
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tradewatch.llm import bpe, mixing, near_dups, quality, secrets, sharding, substrings, token_shards, topk, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n_words string, taken string"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def table(spark, rows):
    """Documents with extra columns whose names clash with those of results."""
    return spark.createDataFrame([(i, t, la, s, None if t is None else len(t), "x", "y") for i, t, la, s in rows], DOCS)


PROSE = " ".join(f"w{i % 37}{i % 11} lorem{i % 7}" for i in range(60))
ODD = [
    (1, PROSE, "en", "a"), (2, PROSE, "en", "a"), (2, PROSE, "en", "a"), (None, "short text", None, None), (5, None, "en", "b"),
    (6, "", None, "b"), (7, "é" * 3000 + " password=abcdef12 \n" + "x" * 25, "fr", "b"), (8, " \t\n ", "en", None),
    (9, PROSE + " tail", "en", "c"), (None, None, None, None),
]


@pytest.fixture(scope="module")
def odd(spark):
    return table(spark, ODD).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def size(text):
    return len(WORDS.findall(text or ""))


def test_mixture_meets_targets_and_limits(odd):
    rows = mixing.mixture(odd).collect()
    assert len(rows) == len(ODD)
    for source in {r.source for r in rows}:
        own = [r for r in rows if r.source == source]
        assert sum(r.taken for r in own) == int(own[0].target // 1)
        assert own[0].target <= 3 * own[0].source_size
    assert all(r.taken <= 3 * r.size for r in rows)
    assert all((r.position is None) == (r.taken == 0) for r in rows)


def test_schedule_inverts_its_integral(spark):
    for schedule in mixing.CURRICULUM:
        u = 0.37
        t = spark.range(1).select(mixing.time_of(F.lit(u), schedule)).first()[0]
        grid = np.linspace(0, t, 100_001)
        height = np.interp(grid, [k[0] for k in schedule], [k[1] for k in schedule])
        area = ((height[1:] + height[:-1]) / 2 * np.diff(grid)).sum()
        assert abs(area / mixing.weight_of(schedule) - u) < 1e-6


def test_training_stream_takes_the_same_words(odd):
    taken = sum(r.taken for r in mixing.mixture(odd).collect())
    stream = mixing.training_stream(odd)
    assert stream.columns == odd.columns
    assert sum(size(r.text) for r in stream.collect()) == taken


def test_ring_fills_shards_evenly(odd):
    rows = sharding.document_shards(odd, shards=4, virtual_nodes=8).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in rows) == sorted(
        (i is None, i or 0, len((t or "").encode()) + 16) for i, t, _, _ in ODD
    )
    counts = Counter(r.shard for r in rows)
    assert max(counts.values()) - min(counts.values()) <= 1
    for shard, n in counts.items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(n))
    assert {r.text_crc32 for r in rows if r.doc_id == 1} == {zlib.crc32(PROSE.encode())}


def test_hot_key_is_spread_over_shards(spark):
    docs = table(spark, [(1, "same", "en", "a")] * 5000 + [(i, "other", "en", "a") for i in range(2, 2002)])
    counts = Counter(r.shard for r in sharding.document_shards(docs, shards=7, virtual_nodes=16).collect())
    assert sorted(counts.values()) == [1000] * 7


def test_quality_counts_and_verdicts(odd):
    rows = {(r.doc_id, r.n_words): r for r in quality.document_quality(odd).collect()}
    r = rows[(1, 120)]
    words = PROSE.split()
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {i + j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(8)}
    assert (r.word_chars, r.n_repeat_words) == (sum(map(len, words)), len(covered))
    assert rows[(5, 0)].base_failed and not rows[(5, 0)].kept
    kept = quality.kept_documents(odd)
    assert kept.columns == odd.columns


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=6).astype(np.float32).tolist()) for i in range(150)]
    rows += [(20, [1.0, None]), (None, [1.0]), (300, None), (301, [float("nan")]), (140, [0.5] * 6), (141, [0.5] * 6), (302, [])]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, row int, numbers string")
    got = topk.top_k(df, k=5, block_rows=16, query_rows=3).collect()
    good = [(i, [int(np.floor(64 * float(np.float32(x)))) for x in v]) for i, v in rows
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for row, (q, own) in enumerate(good):
        if q % 20 == 0:
            scores = sorted((-sum(a * b for a, b in zip(own, v)), i) for j, (i, v) in enumerate(good) if j != row)[:5]
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scores)]
    assert sorted(tuple(r) for r in got) == sorted(want)


def test_top_k_of_repeated_ids(spark):
    """Each row of a repeated id is a query, and a candidate of the others."""
    rows = [(20, [1.0]), (20, [2.0]), (1, [3.0]), (2, [-1.0])]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert sorted((r["rank"], r["vec_id"], r["score"]) for r in got) == sorted(
        [(1, 1, 12288), (2, 20, 8192), (3, 2, -4096), (1, 1, 24576), (2, 20, 8192), (3, 2, -8192)]
    )


def test_warc_round_trip_and_revisits(spark):
    pages = spark.createDataFrame(
        [(1, "http://a/é b\r\nX: y", "<p>one</p>"), (2, None, "<p>one</p>"), (3, "u", None), (4, "u", ""), (5, "u", "ü" * 100_000)],
        "page_id long, url string, html string",
    )
    rows = {r.page_id: r for r in warc.round_trip(pages).collect()}
    assert len(rows) == 5
    assert (rows[1].record_type, rows[1].refers_to, rows[2].record_type) == ("revisit", 2, "response")
    assert (rows[3].record_type, rows[3].refers_to, rows[3].payload_bytes) == ("revisit", 4, 0)
    assert rows[5].payload_bytes == 200_000
    digest = base64.b32encode(hashlib.sha1("ü".encode() * 100_000).digest()).decode()
    assert rows[5].payload_digest == digest


def test_warc_html_is_not_shuffled(spark):
    rows = [(i, "u", f"page {i % 40} " * 50) for i in range(60)] + [(None, "u", "page 1 " * 50), (None, "u", "none"), (None, None, "none"), (90, "u", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    frame = warc.with_revisits(pages)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "SortMergeJoin" not in plan
    last = {html: max((r[0] for r in rows if r[2] == html and r[0] is not None), default=None) for _, _, html in rows}
    want = [(i, (html or "").encode(), None if last[html] == i else last[html]) for i, _, html in rows]
    assert sorted(((r["page_id"], bytes(r["payload"]), r["refers_to"]) for r in frame.collect()), key=str) == sorted(want, key=str)
    assert {r["record_type"] for r in warc.round_trip(pages.limit(0)).collect()} == set()


def test_repeated_digests_too_many_to_broadcast(spark, monkeypatch):
    rows = [(i, "u", f"page {i % 40}") for i in range(100)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    few = warc.with_revisits(pages)
    monkeypatch.setattr(warc, "broadcast_if_small", lambda df: df.hint("merge"))
    many = warc.with_revisits(pages)
    assert "SortMergeJoin" in many._jdf.queryExecution().executedPlan().toString()
    assert sorted(many.collect(), key=str) == sorted(few.collect(), key=str)


def test_warc_payloads_stay_out_of_rows_without_them(spark, folder):
    pages = spark.createDataFrame([(i, "u", "x" * i) for i in range(30)], "page_id long, url string, html string")
    warc.write_archives(pages, f"{folder}/warc", records_per_file=7)
    whole, bare = warc.read_archives(spark, f"{folder}/warc"), warc.read_archives(spark, f"{folder}/warc", payload=False)
    assert bare.columns == whole.columns[:-1] and whole.columns[-1] == "payload"
    assert sorted(bare.collect()) == sorted(whole.drop("payload").collect()) and bare.count() == 30
    plan = warc.round_trip(pages)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "payload#" not in plan


def test_unpacking_copies_no_file_for_a_member():
    """A member costs its own bytes, whatever stands behind it; its end and content don't depend on where pieces are cut."""
    contents = [b"a" * n for n in (0, 1, 500_000)] + [np.random.default_rng(2).bytes(n) for n in (warc.PIECE - 23, 3 * warc.PIECE + 5)]
    members = [gzip.compress(c) for c in contents]
    data, at = b"".join(members) + bytes(20_000_000), 0
    for content, packed in zip(contents, members):
        assert warc.unpack(data, at) == (content, at + len(packed))
        at += len(packed)
    tracemalloc.start()
    warc.unpack(data, 0)
    assert tracemalloc.get_traced_memory()[1] < 1_000_000
    tracemalloc.stop()
    assert warc.member(warc.SEPARATOR + data, 0) == ([], len(warc.SEPARATOR))
    with pytest.raises(warc.Damaged, match="cut off"):
        warc.unpack(members[-1][:-1], 0)
    with pytest.raises(warc.Damaged, match="gzip"):
        warc.unpack(members[-1][:-8] + b"12345678", 0)


def test_salvage_recovers_later_records():
    members = [gzip.compress(warc.record(i, "u", b"payload %d" % i, None)) for i in range(5)]
    torn = bytearray(b"".join(members))
    start = len(members[0])
    torn[start + 30] ^= 0xFF
    events = list(warc.salvage(bytes(torn)))
    assert [e[3]["warc-record-id"] for e in events if e[0] == "record"] == [f"<urn:page:{i}>" for i in (0, 2, 3, 4)]
    assert [(e[1], e[2]) for e in events if e[0] == "gap"] == [(start, start + len(members[1]))]
    plain = b"junk\n" + warc.record(1, "u", b"abc", None) + warc.record(2, "u", b"abc", None)[:-9]
    kinds = [e[0] for e in warc.salvage(plain)]
    assert kinds == ["gap", "record", "gap"]
    assert list(warc.salvage(b"")) == []


def _salvaged(data):
    events = list(warc.salvage(data))
    return [e[3]["warc-record-id"] for e in events if e[0] == "record"], [e[1:] for e in events if e[0] == "gap"]


def test_salvage_inside_a_member():
    """One bad record costs itself only, also if the archive is one gzip member, cut off or damaged."""
    rng = np.random.default_rng(3)
    records = [warc.record(i, "u", rng.bytes(3000), None) for i in range(5)]
    names = [f"<urn:page:{i}>" for i in range(5)]
    bad = [records[0], records[1][:-20] + b"x" + records[1][-19:], *records[2:]]
    packed = gzip.compress(b"".join(bad))
    got, gaps = _salvaged(packed)
    assert got == names[:1] + names[2:]
    (start, stop, reason), = gaps
    assert (start, stop) == (0, len(packed)) and reason.startswith("payload digest differs")
    assert f"{len(records[0])} to {len(records[0]) + len(records[1])}" in reason
    got, gaps = _salvaged(packed[:-3000] + gzip.compress(records[1]))
    assert got == [names[0], names[2], names[3], names[1]] and any("cut off" in g[2] for g in gaps)
    torn = bytearray(gzip.compress(b"".join(records), 0))
    torn[len(records[0]) + len(records[1]) + 1500] ^= 1
    got, gaps = _salvaged(bytes(torn))
    assert got == names[:2] + names[3:] and any("gzip" in g[2] for g in gaps)
    one = bytearray(gzip.compress(records[0], 0))
    one[one.index(b"urn:page:0") + 9] ^= 1
    assert _salvaged(bytes(one))[0] == []


def test_payload_digest_of_http_messages():
    def response(head, body, named):
        block = b"HTTP/1.1 200 OK\r\n" + head + b"\r\n" + body
        return (f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <r>\r\nContent-Type: application/http; msgtype=response\r\n"
                f"WARC-Payload-Digest: {named}\r\nContent-Length: {len(block)}\r\n\r\n").encode() + block + b"\r\n\r\n"

    whole = "sha1:" + warc.digest(b"body")
    assert _salvaged(response(b"A: b\r\n", b"body", whole)) == (["<r>"], [])
    chunked = b"Transfer-Encoding: chunked\r\n"
    assert _salvaged(response(chunked, b"2\r\nbo\r\n2\r\ndy\r\n0\r\n\r\n", whole)) == (["<r>"], [])
    assert _salvaged(response(b"", b"body", "sha1:" + hashlib.sha1(b"body").hexdigest())) == (["<r>"], [])
    assert _salvaged(response(b"", b"body", "sha256:" + hashlib.sha256(b"body").hexdigest())) == (["<r>"], [])
    assert _salvaged(response(b"", b"body", "blake9:abc")) == (["<r>"], [])
    assert _salvaged(response(b"", b"bodY", whole))[0] == []


def test_secret_spans(odd, spark):
    rows = {r.doc_id: r for r in secrets.secret_spans(odd).where("doc_id is not null").collect()}
    r = rows[7]
    assert (r.n_assign, r.n_access, r.n_hex) == (1, 0, 0)
    assert r.base_sha256 == hashlib.sha256(b"assign:3001:3018").hexdigest()
    assert "assign:3001:3018" in r.spans
    assert rows[5].base_sha256 == hashlib.sha256(b"").hexdigest()
    masked = secrets.masked_documents(odd)
    assert masked.columns == odd.columns
    assert "abcdef12" not in masked.where("doc_id = 7").first().text


def test_field_adds_to_pattern_matches(monkeypatch):
    """What a field's span adds to a pattern match stays, before and after it."""
    text = b"x password=hunter22!Zq#9 then Zq#8'password=hunter33;tail y"
    words = [(m.start(), m.end(), 3) for m in re.finditer(rb"\S*password\S*", text)]
    monkeypatch.setattr(secrets, "field_spans", lambda texts, model: [list(words)])
    (base, extra), = secrets.find([text], ())
    assert [text[a:b] for a, b, _ in base] == [b"password=hunter22", b"password=hunter33"]
    assert [text[a:b] for a, b, _ in extra] == [b"!Zq#9", b"Zq#8'", b";tail"]
    assert secrets.masked(text, base + extra).replace(secrets.MASK, b"") == b"x  then  y"
    assert secrets.outside((0, 5, 3), [(0, 3, 0), (2, 5, 1)]) == [] and secrets.outside((4, 6, 3), [(0, 4, 0), (6, 9, 0)]) == [(4, 6, 3)]
    assert secrets.outside((0, 9, 3), [(1, 7, 0), (2, 3, 1)]) == [(0, 1, 3), (7, 9, 3)]


def test_training_texts_differ(spark, monkeypatch):
    monkeypatch.setattr(secrets, "SAMPLE", 3)
    texts = [f"{word} {i}" for i in range(4) for word in ("password=abcdef", "plain")]
    hits, others = secrets.sample(table(spark, [(i, t, "en", "a") for i, t in enumerate(texts * 5)]).repartition(3))
    assert len(set(hits)) == 3 == len(hits) and len(set(others)) == 3 == len(others)
    assert all(t.startswith(b"password") for t in hits) and all(t.startswith(b"plain") for t in others)


def test_viterbi_pieces_equal_the_whole_chain():
    rng = np.random.default_rng(5)
    for _ in range(50):
        n = int(rng.integers(1, 30))
        score, moves = rng.normal(size=(n, 3)) * 3, rng.normal(size=(3, 3))
        score[:, 0] += rng.integers(0, 12, n)
        best, back = score[0], []
        for t in range(1, n):
            to = best[:, None] + moves
            back.append(to.argmax(0))
            best = to.max(0) + score[t]
        tags = [int(best.argmax())]
        for b in reversed(back):
            tags.append(int(b[tags[-1]]))
        first = np.zeros(n, bool)
        first[0] = True
        assert secrets.decode(score, moves, first).tolist() == tags[::-1]


def test_bpe_equals_the_library(odd):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    codec = bpe.Codec(bpe.vocabulary_file())
    texts = ["", " ", "a  b", "\n a", "x <|endoftext|> y", "a<|endoftext|>b  c", "don't  we'll", " " * 5000 + "a", "😀 " * 3000, "é" * 9000, PROSE * 40]
    for text in texts:
        ids = codec.encode(text.encode())
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
        assert codec.decode(ids) == text.encode()
    got = {r.doc_id: r for r in bpe.document_tokens(odd).where("doc_id is not null").collect()}
    ids = library.encode(PROSE, add_special_tokens=False).ids
    assert got[1].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert got[5].n_tokens == 0


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("bucket_rows", [5000, 1])
def test_repeats_equal_brute_force(spark, keep_first, bucket_rows):
    rng = np.random.default_rng(7)
    word = lambda n: "".join(rng.choice(list("abcdé "), n))
    shared = word(120)
    rows = [(1, word(80) + shared + word(50)), (2, shared + word(90)), (3, shared[:60]), (4, word(200)), (5, "ab" * 120), (6, None), (7, word(10))]
    rows += [(8, rows[3][1]), (9, shared[10:])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    length = 40
    got = {r.doc_id: bytes(r.kept) for r in substrings.removed_repeats(
        df, keep_first, length=length, gram=8, bucket_rows=bucket_rows, digests=False).collect()}
    seen = Counter()
    for _, t in rows:
        b = (t or "").encode()
        seen.update(b[k : k + length] for k in range(len(b) - length + 1))
    before = set()
    for i, t in rows:
        b = (t or "").encode()
        out = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            w = b[k : k + length]
            if (w in before) if keep_first else seen[w] > 1:
                out[k : k + length] = True
            before.add(w)
        assert got[i] == bytes(np.frombuffer(b, np.uint8)[~out]), i


def test_shards_hold_every_sequence_once(odd, folder, spark):
    token_shards.write_shards(odd, f"{folder}/t", length=16, shard_places=64)
    rows = token_shards.read_shards(spark, f"{folder}/t", length=16).collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
    codec, want = bpe.Codec(bpe.vocabulary_file()), Counter()
    for i, t, _, _ in ODD:
        ids = codec.encode((t or "").encode()).astype("<u2")
        want.update((i, n, ids[k : k + 16].tobytes()) for n, k in enumerate(range(0, len(ids), 16)))
    assert Counter((r.doc_id, r.sequence, bytes(r.ids)) for r in rows) == want
    rest = token_shards.read_shards(spark, f"{folder}/t", length=16, first=20).collect()
    assert sorted(r.slot for r in rest) == list(range(20, len(rows)))


def test_feistel_permutes():
    for n in (1, 2, 3, 100, 1000):
        assert sorted(token_shards.feistel(np.arange(n), n).tolist()) == list(range(n))


def test_near_duplicates_equal_brute_force(spark):
    rng = np.random.default_rng(11)
    vocabulary = [f"W{i}" for i in range(300)]
    base = [list(rng.choice(vocabulary, 120)) for _ in range(6)]
    rows = [(900, None), (901, ""), (902, "One two"), (903, "one TWO"), (904, " \n")]
    for i in range(160):
        words = list(base[i % 6])
        for _ in range(int(rng.integers(0, 6))):
            words[int(rng.integers(0, 120))] = vocabulary[int(rng.integers(0, 300))]
        rows.append((i, " ".join(words)))
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dups.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string"), block=16).collect()}
    sets = []
    for _, t in rows:
        w = (t or "").lower().split()
        sets.append({tuple(w)} if 0 < len(w) < 3 else {tuple(w[k : k + 3]) for k in range(len(w) - 2)})
    name = {i: i for i, _ in rows}
    changed = True
    while changed:
        changed = False
        for a in range(len(rows)):
            for b in range(a):
                both = len(sets[a] & sets[b])
                if both and 100 * both >= 85 * len(sets[a] | sets[b]):
                    low = min(name[rows[a][0]], name[rows[b][0]])
                    for x in (rows[a][0], rows[b][0]):
                        changed |= name[x] != low
                        name[x] = low
    assert got == {(i, len(s), name[i], name[i] == i) for (i, _), s in zip(rows, sets)}


def test_links_go_by_bytes(spark):
    """Letters outside ASCII keep their case and no-break spaces part nothing, in the verification as in the signatures."""
    plain = [f"é{i}" for i in range(200)]
    capitals = lambda n: " ".join(w.upper() if i % 30 == 5 and i // 30 < n else w for i, w in enumerate(plain))
    spaces = " ".join(f"x{i}" for i in range(205))
    joined = spaces
    for i in range(5):
        joined = joined.replace(f"x{30 * i + 7} ", f"x{30 * i + 7}\u00a0")
    linked = " ".join(plain).replace("é", "à")
    rows = [(1, " ".join(plain)), (2, capitals(6)), (3, spaces), (4, joined), (5, linked), (6, linked.replace("à7 ", "À7 "))]
    sets = [set(zip(w, w[1:], w[2:])) for w in (t.encode().lower().split() for _, t in rows)]
    alike = [len(sets[i] & sets[i + 1]) / len(sets[i] | sets[i + 1]) for i in (0, 2, 4)]
    assert 0.83 < alike[0] < 0.85 and 0.83 < alike[1] < 0.85 < alike[2]
    got = {r.doc_id: r.component_id for r in near_dups.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 5}


def test_rows_that_share_a_doc_id(spark):
    """Texts are told apart though doc_ids repeat or are missing, and one row of each group stays."""
    other = " ".join(f"x{i} y{i % 13}" for i in range(80))
    near = PROSE + " tail"
    rows = [(1, PROSE), (1, other), (1, PROSE), (None, near), (None, other), (2, near), (3, ""), (3, ""), (None, None), (None, "apart from all")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r.doc_id, r.component_id) for r in near_dups.near_duplicates(docs).collect())
    assert got == Counter([(1, 1)] * 3 + [(None, 1)] * 2 + [(2, 1)] + [(3, 3)] * 2 + [(None, None)] * 2)
    kept = Counter(map(tuple, near_dups.distinct_documents(docs).collect()))
    assert kept == Counter([(1, PROSE), (1, other), (3, ""), (3, ""), (None, None), (None, "apart from all")])


def test_empty_tables(empty, spark):
    for operator in (mixing.mixture, sharding.document_shards, quality.document_quality, secrets.secret_spans,
                     bpe.document_tokens, substrings.document_repeats, near_dups.near_duplicates):
        assert operator(empty).count() == 0, operator
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(vectors).count() == 0 and topk.lanes(10**9, 8192) > topk.lanes(10**6, 8192) > topk.LANES[0]


def test_pipeline_stages(odd, spark, folder):
    docs = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns, name
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    assert set(corpus_pipeline.STAGES[-1][1](spark, docs, folder).columns) >= {"doc_id", "n_tokens"}
