"""Secret scan: fixed patterns, and a linear-chain conditional random field that adds spans.

The field tags words as B(egin), I(nside) or O(utside) a secret. A word's features are its shape (shares of digits, upper,
lower and other characters, length, changes of class, whether it assigns or is an address), the shapes of its neighbours,
and whether the file has assignments or braces. Tags are decoded by Viterbi.

Training maximises the likelihood on at most ``SAMPLE`` different excerpts with pattern matches and as many without, chosen
by hash in one pass. Pattern matches alone would teach the field what the patterns know; so secrets of other forms, made by
rule, stand in the excerpts without matches, beside made words that only look odd (rulers, identifiers, addresses, paths,
numbers), which are no secrets. The made forms differ from those that the tests hold out.

Words whose best tag is O by more than all transitions around them could change are O in the best path, whatever the
others are; the chain falls into short pieces between them, which are decoded exactly.

Defined cases: a null text is empty; empty texts have no spans (the digest of an empty list); equal rows get equal
results; without any text there is nothing to learn from; an empty table gives an empty result; other columns pass through or are ignored as stated.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewatch.llm.common import staged

#: Kinds in order, their patterns, and the least characters of group 2 or of the match.
KINDS = ("assign", "access", "hex", "field")
ASSIGN = re.compile(
    rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE
)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{24,}")
NAMES = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
LEAST_ASSIGN, LEAST_ACCESS = 6, 20

SAMPLE = 300
SAMPLE_CHARS = 700
STEPS = 150
RATE = 0.15
RIDGE = 1e-3
O, B, I = 0, 1, 2
MASK = b"[SECRET]"
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_TELLING = re.compile(rb"[0-9A-Za-z\x80-\xFF]")
_TRIM = b"\"'`,;()[]{}<>"


def base_spans(text: bytes) -> list[tuple[int, int, int]]:
    """(start, end, kind) in bytes of every pattern match, sorted."""
    out = []
    low = text.lower()
    if any(name in low for name in NAMES):
        out += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m.group(2)) >= LEAST_ASSIGN]
    if b"AKIA" in text:
        out += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    out += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return sorted(out)


def _class_table() -> np.ndarray:
    table = np.full(256, 4, np.uint8)  # other
    table[48:58], table[65:91], table[97:123], table[128:] = 0, 1, 2, 3  # digit, upper, lower, not ASCII
    for c in b"\t\n\v\f\r ":
        table[c] = 5
    for c in b":=":
        table[c] = 6
    for c in b"+/_-.":
        table[c] = 7
    return table


CLASSES = _class_table()
OWN, FILE = 19, 2
#: Weights of a word's own shape, of the word before, of the word after, and of the file, by tag.
WIDTH = 3 * OWN + FILE


class Words:
    """The words of a list of texts, laid end to end: starts and ends in the whole, the text that each belongs to, where
    texts begin, and the features of words and files, all from running counts over the bytes."""

    def __init__(self, texts: list[bytes]):
        data = b"\n".join([*texts, b""])
        self.offsets = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
        raw = np.frombuffer(data, np.uint8)
        kind = CLASSES[raw]
        word = np.concatenate([[False], kind != 5, [False]])
        edges = np.flatnonzero(word[1:] != word[:-1])
        self.starts, self.ends = starts, ends = edges[::2], edges[1::2]
        self.text = np.searchsorted(self.offsets, starts, "right") - 1
        n = len(starts)
        self.own, self.file = np.zeros((n, OWN), np.float32), np.zeros((len(texts), FILE), np.float32)
        self.first = np.ones(n, bool)
        self.first[1:] = self.text[1:] != self.text[:-1]
        self.file[:, 0] = [b"=" in t for t in texts]
        self.file[:, 1] = [b"{" in t or b";" in t for t in texts]
        if not n:
            return
        length = (ends - starts).astype(np.float32)
        share = np.empty((7, n), np.float32)
        for row, c in enumerate((0, 1, 2, 3, 4, 6, 7)):  # up to the next word's start, but white space is in none of these
            share[row] = np.add.reduceat(kind == c, starts, dtype=np.int32)
        digits, upper, lower, _, _, sign, _ = share
        change = np.cumsum(kind[1:] != kind[:-1], dtype=np.int32)
        change = np.concatenate([np.zeros(1, np.int32), change])
        changes = change[ends - 1] - change[starts]
        own = self.own
        own[:, 0:7] = (share / length).T
        own[:, 7:12] = length[:, None] > np.array([5, 9, 15, 19, 31], np.float32)
        own[:, 12] = changes > 3
        own[:, 13] = changes > 7
        own[:, 14] = (digits > 0) & (upper + lower > 0)
        own[:, 15] = (digits == 0) & (upper <= 1)
        own[:, 16] = sign > 0
        last = raw[ends - 1]
        own[:, 17] = (last == 58) | (last == 61)
        own[:, 18] = np.add.reduceat(raw == 64, starts, dtype=np.int32) > 0  # an address

    def scores(self, weights: np.ndarray) -> np.ndarray:
        """Emission score of every tag for every word."""
        w = weights.astype(np.float32)
        out = self.own @ w[:OWN] + (self.file @ w[3 * OWN :])[self.text]
        inner = ~self.first[1:]
        out[1:][inner] += (self.own[:-1] @ w[OWN : 2 * OWN])[inner]
        out[:-1][inner] += (self.own[1:] @ w[2 * OWN : 3 * OWN])[inner]
        return out

    def matrix(self) -> np.ndarray:
        """All WIDTH features of every word (for training)."""
        out = np.zeros((len(self.starts), WIDTH))
        inner = ~self.first[1:]
        out[:, :OWN] = self.own
        out[1:, OWN : 2 * OWN][inner] = self.own[:-1][inner]
        out[:-1, 2 * OWN : 3 * OWN][inner] = self.own[1:][inner]
        out[:, 3 * OWN :] = self.file[self.text]
        return out


def tags_of(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int, int]]) -> np.ndarray:
    """The tags that pattern matches give to words."""
    tags = np.zeros(len(starts), np.int8)
    for a, b, _ in spans:
        first, stop = np.searchsorted(ends, a, "right"), np.searchsorted(starts, b, "left")
        for w in range(first, stop):
            tags[w] = B if w == first and tags[w] == O else I if tags[w] == O else tags[w]
    return tags


_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"


def _drawn(rng: random.Random, letters: str, low: int, high: int) -> str:
    return "".join(rng.choice(letters) for _ in range(rng.randint(low, high)))


def made_secret(rng: random.Random) -> str:
    """A secret of a form that no pattern matches: random letters and digits in one of several frames."""
    mixed = _UPPER + _LOWER + _DIGITS
    body = _drawn(rng, mixed, 24, 64)
    form = rng.randrange(7)
    if form == 0:
        return body
    if form == 1:
        return f"{_drawn(rng, _LOWER, 2, 4)}{rng.choice('_-')}{body}"
    if form == 2:
        return f"{_drawn(rng, _LOWER, 2, 3)}_{_drawn(rng, _LOWER, 4, 4)}_{body}"
    if form == 3:
        return ".".join(_drawn(rng, mixed + "-_", 18, 40) for _ in range(3))
    if form == 4:
        return _drawn(rng, mixed + "+/", 30, 60) + "=" * rng.randint(0, 2)
    if form == 5:
        return "-".join(_drawn(rng, _UPPER + _DIGITS, 5, 8) for _ in range(5))
    return f"{_drawn(rng, _UPPER, 3, 6)}={body}"


def made_decoy(rng: random.Random) -> str:
    """A word that looks odd and is no secret."""
    word = lambda: _drawn(rng, _LOWER, 3, 9)
    form = rng.randrange(13)
    if form == 12:  # an assignment of a plain or odd word
        sign, value = rng.choice([" = ", ": ", "=", ":", " := "]), rng.choice([word(), '"' + rng.choice("#*-x") * rng.randint(2, 9), str(rng.randint(0, 99))])
        return f"{word()}{sign}{value}"
    if form == 0:
        return rng.choice(["", "", '"', "("]) + rng.choice("#*-=_~.|$%&") * rng.randint(2, 40)
    if form == 1:
        return "_".join(word() for _ in range(rng.randint(2, 5)))
    if form == 2:
        return word() + "".join(word().capitalize() for _ in range(rng.randint(1, 3)))
    if form == 3:
        return f"https://{word()}.{word()}.org/{word()}/{word()}-{rng.randint(1, 9999)}.html"
    if form == 4:
        return f"{word()}.{word()}@{word()}.com"
    if form == 5:
        return f"/{word()}/{word()}/{word()}.{_drawn(rng, _LOWER, 2, 3)}"
    if form == 6:
        return f"{rng.randint(1, 28)}.{rng.randint(1, 12)}.{rng.randint(1900, 2030)}"
    if form == 7:
        return f"+{rng.randint(1, 99)}-{rng.randint(100, 999)}-{rng.randint(100, 999)}-{rng.randint(1000, 9999)}"
    if form == 8:
        return _drawn(rng, _DIGITS, 4, 16)
    if form == 9:
        return word() + rng.choice("###|$$$|%%%|***|&&&|<<<|>>>".split("|")) + rng.choice(["", '"', word()])
    if form == 10:
        return "".join(word() for _ in range(rng.randint(3, 6))) + rng.choice(["", ".", ","])
    return rng.choice(['"', "(", "["]) + word().upper() + rng.choice(['"', ")", "]", ":"])


def salted(text: bytes, number: int) -> tuple[bytes, list[tuple[int, int, int]]]:
    """An excerpt with made secrets and decoys between its words, and where the secrets stand."""
    rng = random.Random(f"salted-{number}")
    words, out, spans, at = text.split(b" "), [], [], 0
    for word in words:
        add = [(word, False)]
        if rng.random() < 0.02:
            add.append((made_secret(rng).encode(), True))
        if rng.random() < 0.06:
            add.append((made_decoy(rng).encode(), False))
        for piece, secret in add:
            if secret:
                spans.append((at, at + len(piece), 3))
            out.append(piece)
            at += len(piece) + 1
    return b" ".join(out), spans


def examples(hits: list[bytes], others: list[bytes]) -> list[tuple[bytes, list]]:
    """Training texts with their spans: excerpts with pattern matches, excerpts without, and the latter once more, salted."""
    plain = [(text, base_spans(text)) for text in hits + others]
    return plain + [salted(text, number) for number, text in enumerate(others)]


def train(labelled: list[tuple[bytes, list]]) -> tuple[np.ndarray, np.ndarray] | None:
    """Emission weights (WIDTH x 3) and transitions (3 x 3) by Adam steps on the log-likelihood of texts with spans."""
    chains = []
    for text, spans in labelled:
        words = Words([text])
        if len(words.starts):
            chains.append((words.matrix(), tags_of(words.starts, words.ends, spans).astype(int)))
    if not any((y > 0).any() for _, y in chains):
        return None
    chains.sort(key=lambda c: -len(c[1]))
    longest, count = len(chains[0][1]), len(chains)
    x = np.zeros((count, longest, WIDTH))
    y = np.zeros((count, longest), int)
    here = np.zeros((count, longest))
    for i, (features, tags) in enumerate(chains):
        x[i, : len(tags)], y[i, : len(tags)], here[i, : len(tags)] = features, tags, 1
    weights, moves = np.zeros((WIDTH, 3)), np.zeros((3, 3))
    slow = [np.zeros((2, *weights.shape)), np.zeros((2, *moves.shape))]
    flat = (here > 0)
    rows = x[flat]
    del x
    wanted = rows.T @ np.eye(3)[y[flat]]
    pairs = here[:, 1:].astype(bool)
    wanted_moves = np.zeros((3, 3))
    np.add.at(wanted_moves, (y[:, :-1][pairs], y[:, 1:][pairs]), 1)
    for step_no in range(1, STEPS + 1):
        score = np.zeros((count, longest, 3))
        score[flat] = rows @ weights
        forward = np.zeros((count, longest, 3))
        forward[:, 0] = score[:, 0]
        for t in range(1, longest):
            step = np.logaddexp.reduce(forward[:, t - 1, :, None] + moves, axis=1) + score[:, t]
            forward[:, t] = np.where(here[:, t, None] > 0, step, forward[:, t - 1])
        norm = np.logaddexp.reduce(forward[:, -1], axis=1)
        backward = np.zeros((count, longest, 3))
        got_moves = np.zeros((3, 3))
        for t in range(longest - 2, -1, -1):
            to = moves + (score[:, t + 1] + backward[:, t + 1])[:, None, :]
            live = here[:, t + 1, None] > 0
            backward[:, t] = np.where(live, np.logaddexp.reduce(to, axis=2), backward[:, t + 1] * 0)
            both = np.exp(forward[:, t, :, None] + to - norm[:, None, None])
            got_moves += (both * here[:, t + 1, None, None]).sum(0)
        chance = np.exp(forward + backward - norm[:, None, None]) * here[:, :, None]
        grad_w = (wanted - rows.T @ chance[flat]) / count - RIDGE * weights
        grad_m = (wanted_moves - got_moves) / count - RIDGE * moves
        for value, grad, past in ((weights, grad_w, slow[0]), (moves, grad_m, slow[1])):
            past[0] = 0.9 * past[0] + 0.1 * grad
            past[1] = 0.99 * past[1] + 0.01 * grad**2
            value += RATE * (past[0] / (1 - 0.9**step_no)) / (np.sqrt(past[1] / (1 - 0.99**step_no)) + 1e-8)
    return weights, moves


def decode(score: np.ndarray, moves: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The best tags of chains that lie end to end (``first``: where one begins): Viterbi, over the pieces between words
    that are O in any best path."""
    n = len(score)
    tags = np.zeros(n, np.int8)
    swing = 2 * (moves.max() - moves.min())
    words = np.flatnonzero(score[:, O] - np.maximum(score[:, B], score[:, I]) <= swing)
    if not len(words):
        return tags
    ends_chain = np.append(first[1:], True)
    breaks = np.flatnonzero((np.diff(words) > 1) | first[words[1:]]) + 1
    heads, tails = words[np.append(0, breaks)], words[np.append(breaks - 1, len(words) - 1)]
    into = np.where(first[heads][:, None], 0, moves[O])
    out_of = np.where(ends_chain[tails][:, None], 0, moves[:, O])
    single = heads == tails
    tags[heads[single]] = (score[heads] + into + out_of)[single].argmax(1)
    for p in np.flatnonzero(~single):
        best, back = score[heads[p]] + into[p], []
        for t in range(heads[p] + 1, tails[p] + 1):
            to = best[:, None] + moves
            back.append(to.argmax(0))
            best = to.max(0) + score[t]
        tag = int((best + out_of[p]).argmax())
        tags[tails[p]] = tag
        for t in range(tails[p] - 1, heads[p] - 1, -1):
            tag = int(back[t - heads[p]][tag])
            tags[t] = tag
    return tags


def field_spans(texts: list[bytes], model: tuple[np.ndarray, np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """For each text (start, end, 3) in bytes of the spans that the field finds, brackets and quotes trimmed."""
    weights, moves = model
    words = Words(texts)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not len(words.starts):
        return out
    tags = decode(words.scores(weights), moves, words.first)
    found = []
    for w in np.flatnonzero(tags):
        if tags[w] == B or not found or found[-1][1] != w - 1 or words.first[w]:
            found.append([w, w])
        else:
            found[-1][1] = w
    for v, w in found:
        i = int(words.text[v])
        a, b = int(words.starts[v] - words.offsets[i]), int(words.ends[w] - words.offsets[i])
        text = texts[i]
        while a < b and text[a] in _TRIM:
            a += 1
        while b > a and (text[b - 1] in _TRIM or text[b - 1] in b".:!?"):
            b -= 1
        if a < b:
            out[i].append((a, b, 3))
    return out


def find(texts: list[bytes], model) -> list[tuple[list, list]]:
    """For each text all pattern spans, and what the field's spans add outside of them: parts with a letter or digit."""
    found = field_spans(texts, model) if model is not None else [[] for _ in texts]
    out = []
    for text, extra in zip(texts, found):
        base = base_spans(text)
        rests = [rest for e in extra for rest in outside(e, base)]
        out.append((base, [r for r in rests if _TELLING.search(text, r[0], r[1])]))
    return out


def outside(span: tuple[int, int, int], base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The parts of a span that no span of ``base`` (sorted) covers."""
    at, end, kind = span
    out = []
    for a, b, _ in base:
        if a >= end:
            break
        if a > at:
            out.append((at, a, kind))
        at = max(at, b)
    if at < end:
        out.append((at, end, kind))
    return out


def _listing(text: bytes, spans: list[tuple[int, int, int]]) -> str:
    """kind:start:end in code points."""
    if not spans:
        return ""
    if not text.isascii():
        data = np.frombuffer(text, np.uint8)
        points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        spans = [(int(points[a]), int(points[b]), k) for a, b, k in spans]
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in sorted(spans))


def _least_excerpts(batches: Iterator[pa.RecordBatch], size: int, chars: int) -> Iterator[pa.RecordBatch]:
    """Of a task's texts, the ``size`` different excerpts with a match and as many without that hash lowest."""
    least: tuple[dict, dict] = ({}, {})
    for batch in batches:
        for value in batch.column(0).cast(pa.binary()):
            text = value.as_py()
            if not text:
                continue
            spans = base_spans(text)
            start = max(0, spans[0][0] - chars // 2) if spans else 0
            excerpt = text[start : start + chars].decode("utf-8", "ignore").encode()
            kept = least[bool(spans)]
            kept[int.from_bytes(hashlib.blake2b(excerpt, digest_size=8).digest(), "big", signed=True)] = excerpt
            if len(kept) >= 4 * size:
                for key in sorted(kept)[size:]:
                    del kept[key]
    rows = [(bool(hit), key, kept[key]) for hit, kept in enumerate(least) for key in sorted(kept)[:size]]
    kinds = [pa.bool_(), pa.int64(), pa.binary()]
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else ([], [], []), kinds)], ["hit", "order", "excerpt"])


def sample(docs: DataFrame) -> tuple[list[bytes], list[bytes]]:
    """At most SAMPLE different excerpts with pattern matches and SAMPLE others, by hash: of a text, the SAMPLE_CHARS bytes
    around its first match (training only; scans read whole texts). One pass; a task sends no more than the sample."""
    size, chars = SAMPLE, SAMPLE_CHARS
    least = docs.select(F.col("text").cast("string")).mapInArrow(
        lambda b: _least_excerpts(b, size, chars), "hit boolean, order long, excerpt binary"
    )
    least = staged(least, "excerpts")
    found = []
    for hit in (True, False):
        rows = least.where(F.col("hit") == hit).groupBy("order").agg(F.min("excerpt").alias("excerpt")).orderBy("order").limit(size)
        found.append([bytes(r["excerpt"]) for r in rows.collect()])
    return found[0], found[1]


def fit(docs: DataFrame) -> tuple[np.ndarray, np.ndarray] | None:
    """The field, trained on the sample of ``docs``."""
    return train(examples(*sample(docs)))


SPANS = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def _scan(batches: Iterator[pa.RecordBatch], model, mask: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in range(0, batch.num_rows, 250):
            rows = batch.slice(part, 250)
            out, texts = [], rows.column("text").cast(pa.binary()).to_pylist()
            for text, (base, extra) in zip(texts, find([t or b"" for t in texts], model)):
                if mask:
                    out.append(text if text is None else masked(text, base + extra))
                    continue
                counts = [sum(s[2] == k for s in base) for k in range(3)]
                listing = hashlib.sha256(_listing(text or b"", base).encode()).hexdigest()
                out.append((*counts, listing, _listing(text or b"", base + extra)))
            if mask:
                found = [pa.array(out, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays([rows.column("doc"), *found], ["doc", "text"])
                continue
            columns = [pa.array(c, k) for c, k in zip(zip(*out), [pa.int64()] * 3 + [pa.string()] * 2)]
            found = pa.StructArray.from_arrays(columns, [c.split()[0] for c in SPANS.split(", ")])
            yield pa.RecordBatch.from_arrays([rows.column("doc"), found], ["doc", "found"])


def masked(text: bytes, spans: list[tuple[int, int, int]]) -> bytes:
    """The text with every span replaced by MASK; overlapping spans become one."""
    out, at = [], 0
    for a, b, _ in sorted(spans):
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], MASK]
        at = b
    return b"".join([*out, text[at:]])


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("doc"), F.col("text").cast("string"))


def secret_spans(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, base_sha256, and all spans (kinds of KINDS)."""
    model = fit(docs)
    rows = _rows(docs.select("doc_id", "text"))
    schema = T.StructType([rows.schema["doc"], T.StructField("found", T._parse_datatype_string(SPANS))])
    return rows.mapInArrow(lambda b: _scan(b, model, False), schema).select("doc.doc_id", "found.*")


def masked_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of their texts replaced by MASK, and ``n_chars``, if there, kept true."""
    model = fit(docs)
    rows = _rows(docs)
    rows = rows.mapInArrow(lambda b: _scan(b, model, True), rows.schema)
    out = {c: F.col(f"doc.`{c}`") for c in docs.columns if c != "text"} | {"text": F.col("text")}
    if "n_chars" in out:
        out["n_chars"] = F.when(F.col("text").isNull(), out["n_chars"]).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType))
    return rows.select(*[out[c].alias(c) for c in docs.columns])
