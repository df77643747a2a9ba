"""Secret scans: fixed patterns, and a linear-chain conditional random field over tokens that adds what they miss.

A token is a run of word bytes or of other signs. It is tagged as the begin of a secret, inside or outside one, from its shape, the words around it and
features of its text. All features are computed with numpy for a whole batch of texts, and weights are tables over small
codes. Viterbi runs on short stretches only: a token whose score outside exceeds the others by more than transitions can make up for is outside on every best path, so paths
may be cut there, which changes no result."""

from __future__ import annotations

import hashlib
import re
import string
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.llm.common import _power_tables, mix

#: Bounds of the training sample: texts of least hash, tokens of a window, windows a text.
SAMPLE_TEXTS = 1000
WINDOW = 32
WINDOWS = 2
#: What the model adds has at least so many bytes.
LEAST = 8
KINDS = ("assign", "access", "hex", "crf")


def _either(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


#: Fixed patterns of the contract, with the least length of their group, over UTF-8 bytes: all that they name is ASCII.
_KEY = rf"({_either('password')}|{_either('passwd')}|{_either('secret')}|{_either('token')}|{_either('api')}_?{_either('key')})"
BASE = (
    (re.compile((_KEY + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""").encode()), 2, 6),
    (re.compile(rb"AKIA[A-Z0-9]+"), 0, 20),
    (re.compile(rb"[0-9a-f]+"), 0, 24),
)
#: One of these is in every text with a base span of the first two kinds.
_SIGNS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key", b"akia")


def long_runs(inside: np.ndarray, least: int, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the runs of true of at least so many, cut at bounds."""
    edge = np.zeros(len(inside) + 1, bool)
    edge[1:-1] = inside[1:] != inside[:-1]
    edge[bounds] = True
    at = np.flatnonzero(edge)
    begin, end = at[:-1], at[1:]
    long = end - begin >= least
    begin, end = begin[long], end[long]
    ok = inside[begin] if len(begin) else np.zeros(0, bool)
    return begin[ok], end[ok]


def base_spans(raw: bytes, hexes: list[tuple[int, int]] | None = None) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, start of the value) in bytes, by start and kind. hexes are the text's long hexadecimal runs, if they are known."""
    if hexes is None:
        hexes = list(zip(*(x.tolist() for x in long_runs(_HEX[np.frombuffer(raw, np.uint8)], BASE[2][2], np.array([0, len(raw)]))), strict=True)) if raw else []
    out = [(a, 2, z, a) for a, z in hexes]
    low = raw.lower()
    if any(sign in low for sign in _SIGNS):
        for kind, (pattern, group, least) in enumerate(BASE[:2]):
            out += [(m.start(), kind, m.end(), m.start(group)) for m in pattern.finditer(raw) if m.end(group) - m.start(group) >= least]
    return sorted(out)


# Classes of bytes.
_SPACE, _LOWER, _UPPER, _DIGIT, _JOIN, _SIGN, _WIDE = range(7)  # words hold bits 1 to 6 of what they have
_CLASS = np.full(256, _SIGN, np.uint8)
_CLASS[[*range(0x21), 0x7F]] = _SPACE
_CLASS[0x61:0x7B] = _LOWER
_CLASS[0x41:0x5B] = _UPPER
_CLASS[0x30:0x3A] = _DIGIT
_CLASS[[ord(c) for c in "+/_-"]] = _JOIN
_CLASS[0x80:] = _WIDE
_HEX = np.zeros(256, bool)
_HEX[[ord(c) for c in "0123456789abcdef"]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 32
_BIT = np.left_shift(1, _CLASS).astype(np.uint8)
_PART = np.where(_CLASS == _SPACE, 0, np.where(_CLASS == _SIGN, 2, 1)).astype(np.uint8)
_LENGTHS = np.searchsorted([1, 2, 4, 6, 10, 16, 20, 24, 32, 40, 64], np.arange(257), "right").astype(np.uint8)

#: Words that the features know, by group. Fixed values.
WORDS = (
    ("password", "passwd", "passphrase", "pwd", "secret", "secrets", "token", "apikey", "api_key", "api-key", "access_key", "secret_key", "private_key", "client_secret", "auth_token", "access_token"),
    ("key", "auth", "bearer", "credential", "credentials", "authorization", "login", "private", "access", "signature", "aws", "sk", "ghp", "pat"),
    ("http", "https", "www", "com", "html", "example", "url", "id", "commit", "sha", "md5", "uuid", "hash", "checksum", "version"),
)


def _word_hash(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    up, down = _power_tables(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((_FOLD[raw].astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=sums[1:])
    return mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))


def _word_groups() -> tuple[np.ndarray, np.ndarray]:
    hashes, groups = [], []
    for g, words in enumerate(WORDS, 1):
        for w in words:
            raw = np.frombuffer(w.encode(), np.uint8)
            hashes.append(_word_hash(raw, np.array([0]), np.array([len(raw)]))[0])
            groups.append(g)
    order = np.argsort(hashes)
    return np.array(hashes, np.uint64)[order], np.array(groups)[order]


_KNOWN, _GROUP = _word_groups()
#: Feature tables and their sizes, in the order of the columns of features().
TABLES = {"length, digits": 12 * 5, "shape": 128, "switches": 12 * 2, "word": 4, "before": 6 * 4, "before that": 6 * 4, "and that": 6 * 4, "after": 6, "text": 5 * 3, "line": 2, "kind of signs": 6, "long before": 12, "long after": 12}


def features(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, row, codes) of the tokens of texts that lie in raw between bounds; codes has a column a table."""
    group = _PART[raw]
    edge = np.ones(len(raw) + 1, bool)
    edge[1:-1] = group[1:] != group[:-1]
    edge[bounds] = True
    at = np.flatnonzero(edge)
    begin, end = at[:-1], at[1:]
    wordy = group[begin] > 0 if len(begin) else np.zeros(0, bool)
    gap = np.zeros(len(begin), bool)
    gap[1:] = ~wordy[:-1]
    begin, end, gap = begin[wordy], end[wordy], gap[wordy]
    row = np.searchsorted(bounds, begin, "right") - 1
    n = len(begin)
    if not n:
        return begin, end, row, np.zeros((0, len(TABLES)), np.uint8)
    gap[0] = True
    gap[1:] |= row[1:] != row[:-1]
    size = end - begin
    length = _LENGTHS[np.minimum(size, 256)]
    # Sums from a token's begin to the next one's: the blanks between them have no digits and no turns.
    has = np.bitwise_or.reduceat(_BIT[raw], begin)
    kind = _CLASS[raw]
    digit = kind == _DIGIT
    turn = np.zeros(len(raw), bool)
    turn[1:] = (digit[1:] != digit[:-1]) | ((kind[1:] == _UPPER) & (kind[:-1] == _LOWER))
    turn &= ~edge[:-1]
    digits, hex_only = np.add.reduceat(digit, begin, dtype=np.int32), np.add.reduceat(_HEX[raw], begin, dtype=np.int32) == size
    share = np.minimum(4, np.ceil(4 * digits / size)).astype(np.uint8)
    switches = np.minimum(11, np.add.reduceat(turn, begin, dtype=np.int32)).astype(np.uint8)
    sign = group[begin] == 2
    word = np.zeros(n, np.uint8)
    few = np.flatnonzero(~sign & (size <= 16))
    hashed = _word_hash(raw, begin[few], end[few])
    place = np.minimum(np.searchsorted(_KNOWN, hashed), len(_KNOWN) - 1)
    word[few] = np.where(_KNOWN[place] == hashed, _GROUP[place], 0)
    first, last = raw[begin], raw[end - 1]
    assigns, quote = (first == 0x3D) | (first == 0x3A) | (last == 0x3D) | (last == 0x3A), np.isin(last, np.frombuffer(b"\"'`", np.uint8)) | np.isin(first, np.frombuffer(b"\"'`", np.uint8))
    # 0 the text's edge, 1 a word, 2 a word with digits, 3 an assignment, 4 a quote, 5 other signs
    shape = np.where(sign, np.where(assigns, 3, np.where(quote, 4, 5)), np.where(digits > 0, 2, 1)).astype(np.uint8)
    around = shape * np.uint8(4) + word

    def shifted(x: np.ndarray, by: int) -> np.ndarray:
        """x of the token so far away, 0 beyond the text's edge."""
        out = np.zeros(n, np.uint8)
        if n > abs(by):
            if by < 0:
                out[-by:] = np.where(row[-by:] == row[:by], x[:by], 0)
            else:
                out[:-by] = np.where(row[by:] == row[:-by], x[by:], 0)
        return out

    texts = len(bounds) - 1
    tokens = np.maximum(1, np.bincount(row, minlength=texts))
    signs = np.minimum(4, (10 * np.bincount(row[sign], minlength=texts)) // tokens)
    keyed = np.minimum(2, np.bincount(row[word == 1], minlength=texts))
    starts_line = np.ones(n, bool)
    starts_line[1:] = np.logical_or.reduceat(raw == 0x0A, begin)[:-1] | (row[1:] != row[:-1])
    codes = np.empty((n, len(TABLES)), np.uint8, order="F")
    codes[:, 0] = length * np.uint8(5) + share
    codes[:, 1] = (has >> 1) & 63 | (hex_only.astype(np.uint8) << 6)
    codes[:, 2] = switches * np.uint8(2) + gap
    codes[:, 3] = word
    for j, by in ((4, -1), (5, -2), (6, -3)):
        codes[:, j] = shifted(around, by)
    codes[:, 7] = shifted(shape, 1)
    codes[:, 8] = (signs * 3 + keyed)[row]
    codes[:, 9] = starts_line
    codes[:, 10] = np.where(sign, np.where(size > 2, 2, 1) + np.where(assigns, 2, 0), 0)
    codes[:, 11] = shifted(length, -1)
    codes[:, 12] = shifted(length, 1)
    return begin, end, row, codes


_OFFSETS = np.concatenate([[0], np.cumsum(list(TABLES.values()))])
OUT, BEGIN, INSIDE = range(3)


class Crf:
    """Weights of a linear-chain CRF: a table of (code, tag) for all features, and transitions (from, to). Tags are outside, begin and inside."""

    def __init__(self, tables: np.ndarray, transitions: np.ndarray):
        self.tables, self.transitions = tables, transitions

    def scores(self, codes: np.ndarray) -> np.ndarray:
        tables = self.tables.astype(np.float32)
        out = np.zeros((len(codes), 3), np.float32)
        for j in range(len(TABLES)):
            out += np.take(tables[_OFFSETS[j] : _OFFSETS[j + 1]], codes[:, j], axis=0)
        return out

    def decode(self, scores: np.ndarray, row: np.ndarray) -> np.ndarray:
        """The best tags of each row's tokens.

        Where outside scores over the others by more than any change of the two transitions round a token is worth, an optimal path is outside there. Only the stretches
        between such tokens, with one of them (or the text's edge) at each end, go through the recursion."""
        t = self.transitions
        worth = max(t[a, y] + t[y, c] - t[a, OUT] - t[OUT, c] for a in range(3) for c in range(3) for y in (BEGIN, INSIDE))
        edge = max(max(t[a, y] - t[a, OUT], t[y, a] - t[OUT, a]) for a in range(3) for y in (BEGIN, INSIDE))
        sure = scores[:, OUT] - scores[:, 1:].max(axis=1) > max(worth, edge, 0) + 1e-3
        tags = np.zeros(len(scores), np.uint8)
        open_ = np.flatnonzero(~sure)
        if not len(open_):
            return tags
        cut = np.ones(len(open_), bool)
        cut[1:] = (np.diff(open_) > 1) | (row[open_[1:]] != row[open_[:-1]])
        firsts = np.flatnonzero(cut)
        for a, z in zip(open_[firsts], np.append(open_[firsts[1:] - 1], open_[-1]) + 1, strict=True):
            before, after = a > 0 and row[a - 1] == row[a], z < len(row) and row[z] == row[z - 1]
            tags[a:z] = self.viterbi(scores[a:z].astype(float), before, after)
        return tags

    def viterbi(self, scores: np.ndarray, before: bool = False, after: bool = False) -> np.ndarray:
        """The best tags of a sequence, with an outside token before or after it if so told."""
        t = self.transitions
        best = scores[0] + (t[OUT] if before else 0)
        back = np.zeros((len(scores), 3), np.uint8)
        for i in range(1, len(scores)):
            paths = best[:, None] + t
            back[i] = paths.argmax(axis=0)
            best = paths.max(axis=0) + scores[i]
        if after:
            best = best + t[:, OUT]
        tags = np.empty(len(scores), np.uint8)
        tags[-1] = best.argmax()
        for i in range(len(scores) - 1, 0, -1):
            tags[i - 1] = back[i, tags[i]]
        return tags


def fit(codes: np.ndarray, tags: np.ndarray, mask: np.ndarray, rounds: int = 100, l2: float = 1e-3, rate: float = 0.15) -> Crf:
    """Maximises the penalised conditional likelihood of windows (windows x tokens) by Adam on exact gradients (forward and backward sums over all windows at once)."""
    n, length = tags.shape
    width = int(_OFFSETS[-1])
    flat = (codes.astype(np.int64) + _OFFSETS[:-1]).reshape(-1, len(TABLES))
    size = mask.sum(axis=1)
    last = size - 1
    real = mask.reshape(-1)
    w, t = np.zeros((width, 3)), np.zeros((3, 3))
    w[:_OFFSETS[1], OUT] = 0.5
    m = [np.zeros_like(w), np.zeros_like(t)]
    v = [np.zeros_like(w), np.zeros_like(t)]

    def sums(weights: np.ndarray) -> np.ndarray:
        out = np.empty((width, 3))
        for y in range(3):
            out[:, y] = np.bincount(flat[real].ravel(), np.repeat(weights.reshape(-1, 3)[real, y], len(TABLES)), width)
        return out

    gold = np.eye(3)[tags]
    pairs = mask[:, 1:] & mask[:, :-1]
    seen = sums(gold)
    moves = np.zeros((3, 3))
    np.add.at(moves, (tags[:, :-1][pairs], tags[:, 1:][pairs]), 1)
    total = max(1, real.sum())
    for k in range(1, rounds + 1):
        e = w[flat].sum(axis=1).reshape(n, length, 3)
        top = lambda x: x.max(axis=-1, keepdims=True)
        alpha, beta = np.empty((n, length, 3)), np.zeros((n, length, 3))
        alpha[:, 0] = e[:, 0]
        for i in range(1, length):
            x = alpha[:, i - 1][:, :, None] + t
            h = x.max(axis=1)
            alpha[:, i] = h + np.log(np.exp(x - h[:, None]).sum(axis=1)) + e[:, i]
        for i in range(length - 2, -1, -1):
            x = t + (e[:, i + 1] + beta[:, i + 1])[:, None, :]
            h = x.max(axis=2)
            beta[:, i] = np.where(mask[:, i + 1][:, None], h + np.log(np.exp(x - h[:, :, None]).sum(axis=2)), 0)
        end = alpha[np.arange(n), last]
        z = (top(end) + np.log(np.exp(end - top(end)).sum(axis=1, keepdims=True)))[:, :, None]
        node = np.exp(alpha + beta - z) * mask[:, :, None]
        both = np.exp(alpha[:, :-1, :, None] + t + (e[:, 1:] + beta[:, 1:])[:, :, None, :] - z[:, :, :, None])[pairs].sum(axis=0)
        grads = [(seen - sums(node)) / total - l2 * w / 10, (moves - both) / total - l2 * t / 10]
        for p, g, a, b in zip((w, t), grads, m, v, strict=True):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            p += rate * (a / (1 - 0.9**k)) / (np.sqrt(b / (1 - 0.99**k)) + 1e-8)
    return Crf(w, t)


def generated(seed: int) -> str:
    """A credential in one of the usual forms, from hashes of a number."""
    stream = "".join(hashlib.sha256(f"{seed}/{i}".encode()).hexdigest() for i in range(4))
    number = int(stream[:16], 16)
    letters = string.ascii_letters + string.digits
    mixed = "".join(letters[int(stream[2 * i : 2 * i + 2], 16) % 62] for i in range(100))
    forms = (
        stream[16 : 16 + (32, 40, 64)[number % 3]],
        "AKIA" + mixed[:16].upper(),
        "ghp_" + mixed[:36],
        "sk-" + mixed[:48],
        mixed[: 20 + number % 30],
        mixed[:24] + "/" + mixed[24:40] + "+" + mixed[40:60] + "==",
        "eyJ" + mixed[:33] + "." + "eyJ" + mixed[33:70] + "." + mixed[50:93],
        "xoxb-" + str(number % 10**12) + "-" + mixed[:24],
        mixed[:5] + "!" + mixed[5:9] + "#" + mixed[9:14] + "1",
    )
    return forms[(number >> 20) % len(forms)]


#: Ways in which a credential is written, for the training windows.
FRAMES = ('{}', '"{}"', "key: {}", "pwd={}", "auth = '{}'", "Bearer {}", "Authorization: Bearer {}", "password: {}", 'token = "{}"', "api_key={}", "secret '{}'", "credentials {}", "--token {}", "login / {}")


def training_windows(texts: Iterator[tuple[int, str]]) -> Iterator[tuple[bytes, np.ndarray, np.ndarray]]:
    """(text, begins, ends) of cuts of texts, some with a generated credential: the values of base spans and of these credentials are what has to be found."""
    for h, text in texts:
        raw = text.encode()
        spans = base_spans(raw)
        # A cut round each base span and cuts at hashed places, each between blanks.
        places = [s[0] for s in spans[:WINDOWS]] + [int(hashlib.sha256(f"{h}/{i}".encode()).hexdigest()[:12], 16) % max(1, len(raw)) for i in range(WINDOWS)]
        for i, place in enumerate(places):
            a, z = raw.rfind(b" ", 0, max(0, place - 120)) + 1, raw.find(b" ", place + 150)
            cut = raw[a : z if z > 0 else len(raw)]
            marks = [(v, e) for _, _, e, v in base_spans(cut)]
            seed = abs(h) % (1 << 40) * 16 + i
            if not marks and seed // 16 % 2:
                at = cut.rfind(b" ", 0, 120) + 1
                value = generated(seed)
                put = FRAMES[seed // 7 % len(FRAMES)]
                lead = put.split("{}")[0]
                cut = cut[:at] + put.format(value).encode() + b" " + cut[at:]
                marks = [(v, e) for _, _, e, v in base_spans(cut)] + [(at + len(lead), at + len(lead) + len(value))]
            yield cut, np.array([m[0] for m in marks], np.int64), np.array([m[1] for m in marks], np.int64)


def learn(windows: list[tuple[bytes, np.ndarray, np.ndarray]]) -> Crf:
    """A model from windows; without any, one that finds nothing."""
    all_codes, all_tags = [], []
    for cut, begins, ends in windows:
        begin, end, _, codes = features(np.frombuffer(cut, np.uint8), np.array([0, len(cut)]))
        tags = np.zeros(len(begin), np.uint8)
        for a, z in zip(begins, ends, strict=True):
            inside = np.flatnonzero((begin < z) & (end > a))
            # A sign before or behind the value, cut off with it, isn't the value.
            tags[inside] = INSIDE
            if len(inside):
                tags[inside[0]] = BEGIN
        middle = int(np.flatnonzero(tags)[0]) if tags.any() else len(tags) // 2
        a = max(0, middle - WINDOW // 2)
        if len(codes[a : a + WINDOW]):
            all_codes.append(codes[a : a + WINDOW])
            all_tags.append(tags[a : a + WINDOW])
    if not any(t.any() for t in all_tags):
        tables = np.zeros((int(_OFFSETS[-1]), 3))
        tables[: _OFFSETS[1], OUT] = 10.0
        return Crf(tables, np.zeros((3, 3)))
    n = len(all_codes)
    codes, tags, mask = np.zeros((n, WINDOW, len(TABLES)), np.uint8), np.zeros((n, WINDOW), np.int64), np.zeros((n, WINDOW), bool)
    for i, (c, t) in enumerate(zip(all_codes, all_tags, strict=True)):
        codes[i, : len(c)], tags[i, : len(c)], mask[i, : len(c)] = c, t, True
    return fit(codes, tags, mask)


def train(docs: DataFrame, text: str = "text") -> Crf:
    """A model from windows of the SAMPLE_TEXTS texts of least hash: at most 2 * WINDOWS short cuts of each reach the driver, whatever the table holds."""
    hashed = docs.where(F.octet_length(text) > 0).select(F.xxhash64(text).alias("h"), F.col(text).cast("string").alias("t"))
    bound = hashed.select("h").distinct().orderBy("h").limit(SAMPLE_TEXTS).agg(F.max("h")).first()[0]
    if bound is None:
        return learn([])

    def cuts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for h, t in b.itertuples(index=False):
                rows = list(training_windows(iter([(h, t)])))
                yield pd.DataFrame({"h": h, "i": range(len(rows)), "cut": [r[0] for r in rows], "a": [r[1] for r in rows], "z": [r[2] for r in rows]})

    found = hashed.where(F.col("h") <= bound).mapInPandas(cuts, "h long, i int, cut binary, a array<long>, z array<long>").dropDuplicates(["h", "i"])
    rows = sorted(found.collect(), key=lambda r: (r.h, r.i))
    return learn([(bytes(r.cut), np.array(r.a, np.int64), np.array(r.z, np.int64)) for r in rows])


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{z}" for a, k, z in sorted(spans))


def scan(docs: DataFrame, model: Crf, text: str = "text", key: str = "doc_id", run_bytes: int = 1_000_000) -> DataFrame:
    """(key, n_assign, n_access, n_hex, base, spans): base and spans are kind:start:end in code points, by start and then kind, comma-joined.

    The base spans are those of the patterns. spans adds, as crf, what the model finds apart from them. A null or empty text has none; an unpaired
    key, a repeated row or a column of any other name changes nothing: each row is judged by its text."""
    kind = docs.schema[key].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast((model.tables, model.transitions))

    def judged(texts: pa.Array) -> list[tuple[int, int, int, str, str]]:
        crf = Crf(*shared.value)
        texts = pa.concat_arrays([pc.fill_null(texts, "")])
        bounds = np.frombuffer(texts.buffers()[1], np.int32)[: len(texts) + 1].astype(np.int64)
        data = texts.buffers()[2]
        raw = np.frombuffer(data, np.uint8)[: bounds[-1]] if data is not None and bounds[-1] else np.empty(0, np.uint8)
        added: dict[int, list[tuple[int, int]]] = {}
        if len(raw):
            begin, end, row, codes = features(raw, bounds)
            tags = crf.decode(crf.scores(codes), row)
            hit = np.flatnonzero(tags)
            opens = np.ones(len(hit), bool)
            opens[1:] = (tags[hit[1:]] == BEGIN) | (np.diff(hit) > 1) | (row[hit[1:]] != row[hit[:-1]])
            at = np.flatnonzero(opens)
            for a, z in zip(hit[at], np.append(hit[at[1:] - 1], hit[-1:]), strict=True):
                added.setdefault(int(row[a]), []).append((int(begin[a] - bounds[row[a]]), int(end[z] - bounds[row[a]])))
        hexes: dict[int, list[tuple[int, int]]] = {}
        for a, z in zip(*long_runs(_HEX[raw], BASE[2][2], bounds), strict=True) if len(raw) else ():
            i = int(np.searchsorted(bounds, a, "right")) - 1
            hexes.setdefault(i, []).append((int(a - bounds[i]), int(z - bounds[i])))
        out = []
        for i in range(len(texts)):
            base = [(a, k, z) for a, k, z, _ in base_spans(raw[bounds[i] : bounds[i + 1]].tobytes(), hexes.get(i, []))]
            more = [(a, 3, z) for a, z in added.get(i, ()) if z - a >= LEAST and not any(a < e and s < z for s, _, e in base)]
            # From bytes to code points: bytes that continue a character don't count.
            if base or more:
                points = np.concatenate([[0], np.cumsum((raw[bounds[i] : bounds[i + 1]] & 0xC0) != 0x80)])
                base, more = ([(int(points[a]), k, int(points[z])) for a, k, z in s] for s in (base, more))
            counts = [sum(k == j for _, j, _ in base) for k in range(3)]
            out.append((*counts, joined(base), joined(base + more)))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy().astype(np.int64))
            a = 0
            while a < len(size):
                z = max(a + 1, int(np.searchsorted(size, (size[a - 1] if a else 0) + run_bytes)))
                columns = list(zip(*judged(batch.column(1).slice(a, z - a)), strict=True))
                kinds = [pa.int64()] * 3 + [pa.string()] * 2
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, z - a), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], ["key", "n_assign", "n_access", "n_hex", "base", "spans"])
                a = z

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"key {kind}, n_assign long, n_access long, n_hex long, base string, spans string").withColumnRenamed("key", key)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return scan(docs, train(docs)).select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans")
