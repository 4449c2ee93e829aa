"""Secret scan: base patterns, and a linear-chain conditional random field over tokens.

Every token of a text is tagged begin, inside or outside of a secret from its shape, the neighbouring
words and features of the file, and decoded by Viterbi over the whole text.  The texts of a batch are
decoded as one chain with a token between them that may only be outside, which is the same.  The chain
is cut into lanes that advance together: each lane's best scores from every tag before it to every tag
at its end are found first, then the best scores at its entry, then its tags (exact, no beam).

The field learns from a bounded sample of documents, tagged by the base patterns; some copies have
values without their keyword, among other words or none, so that shape counts on its own.
"""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import accumulate, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import free_name

KINDS = ("assign", "access", "hex", "crf")    # in the order in which equal starts are listed
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")            # maximal runs, so the same as runs of any length kept from 24 on
TOKEN = re.compile(r"[A-Za-z0-9+/_.=-]+|[^\sA-Za-z0-9+/_.=-]+")
DIGITS = re.compile(r"[0-9]")
LONG = re.compile(r"[A-Za-z0-9+/_.=-]{8,}")

BITS = 14
SAMPLE_DOCS = 4000
MAX_CHAINS = 20_000
COPIES = 4000                 # copies of chains with secrets, 1 to 16 of each, in which these stand where other tokens do
TRAIN_TOKENS = 32             # tokens of a chain that is learnt from; texts are cut (decoding never is)
TRAIN_SHARE = 16              # of chains without long or numbered tokens, one in so many is learnt from
OUTSIDE, BEGIN, INSIDE = 0, 1, 2
LANE, LANES = 128, 1024       # steps of a lane, lanes that advance together
PART_CHARS, PART_TOKENS = 1 << 20, 1 << 16    # longer texts are tokenized in parts of so many tokens
GROUP_TOKENS = 1 << 20        # texts are decoded together up to about so many tokens
KNOWN_TOKENS, KNOWN_CHARS = 1 << 18, 1 << 24  # tokens whose scores a task remembers
PART_TEXTS = 1024             # texts of a batch that a task holds as strings at once


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns, leftmost and not overlapping within a kind."""
    out = []
    if "=" in text or ":" in text:
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    if DIGITS.search(text) or LONG.search(text):
        out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


# ---- tokens and features ------------------------------------------------------------------

def _kind(c: str) -> str:
    return "d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "p"


_KINDS = {i: _kind(chr(i)) for i in range(128)}
_RUN, _HEX, _UPPER, _MARK, _LETTER = (re.compile(x) for x in (r"(.)\1+", "[0-9a-f]+", "[A-Z0-9]+", "[/.@=]", "[A-Za-z]"))


@lru_cache(maxsize=1 << 14)
def _entropy(counts: tuple[int, ...]) -> float:
    n = sum(counts)
    return -sum(c / n * math.log2(c / n) for c in counts)


def form(token: str) -> tuple:
    """Length, runs of kinds of characters, share of digits, entropy, whether it is hex, all upper-case, holds marks, and
    whether it has eight characters or more of the secret alphabet, with a digit and a letter."""
    n = len(token)
    counts = tuple(sorted(map(token.count, set(token)) if n <= 32 else Counter(token).values()))
    if token.isalpha() and token.isascii() and token.islower():
        return min(n // 4, 12), "l", 0, round(2 * _entropy(counts)), _HEX.fullmatch(token) is not None, False, False, False
    kinds = token.translate(_KINDS) if token.isascii() else "".join(map(_kind, token))
    return (min(n // 4, 12), _RUN.sub(r"\1", kinds)[:8], round(4 * kinds.count("d") / n), round(2 * _entropy(counts)),
            _HEX.fullmatch(token) is not None, _UPPER.fullmatch(token) is not None, _MARK.search(token) is not None,
            n >= 8 and "d" in kinds and LONG.fullmatch(token) is not None and _LETTER.search(token) is not None)


def _near(word: str) -> str:
    return (word if word.isalpha() else DIGITS.sub("0", word[:64])).lower()[:16]


def _bytes(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def _numbers(named: list[str]) -> list[int]:
    return [zlib.crc32(_bytes(f)) & _MASK for f in named]


_MASK = (1 << BITS) - 1
_BEFORE, _BEFORE2, _AFTER, _HEAD = (zlib.crc32(x) for x in (b"before ", b"before2 ", b"after ", b"head "))    # go on with the word


OWN, NEAR, FILE = 10, 3, 2    # features of a token itself, of its neighbours and of its file


def form_features(form: tuple) -> list[int]:
    return _numbers(["1", *[f"{name} {x}" for name, x in zip(("len", "shape", "digits", "entropy", "hex", "upper", "marks", "may"), form)]])


def head_feature(token: str) -> int:
    return zlib.crc32(_bytes(token[:4]), _HEAD) & _MASK


def own_features(token: str) -> list[int]:
    return [*form_features(form(token)), head_feature(token)]


def near_features(word: str) -> list[int]:
    """Of a word ("" beyond the text): as the last before a token, the last but one, and the next."""
    near = _bytes(_near(word))
    return [zlib.crc32(near, _BEFORE) & _MASK, zlib.crc32(near, _BEFORE2) & _MASK, zlib.crc32(near, _AFTER) & _MASK]


def file_features(text: str) -> list[int]:
    lines = text.count("\n") + 1
    return _numbers([f"assigns {min(text.count('=') * 20 // lines, 5)}",
                     f"line {min(int(math.log2(len(text) / lines + 1)), 12)}"])


def token_parts(text: str) -> Iterator[list[str]]:
    """The tokens of ``text``; those of a long one in parts."""
    if len(text) <= PART_CHARS:
        found = TOKEN.findall(text)
        if found:
            yield found
        return
    matches = TOKEN.finditer(text)
    while found := [m.group() for m in islice(matches, PART_TOKENS)]:
        yield found


# ---- the field ----------------------------------------------------------------------------

def _best(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum(np.maximum(a, b), c)


def _lanes(e: np.ndarray, step: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Viterbi over scores ``e`` (steps, lanes, 3); lanes follow each other and ``entry`` is the best score of every tag before.

    Gives the tags (steps, lanes, 3) for each tag at a lane's end, the tag before the lane (lanes, 3) that goes with it, and
    the best scores at the end."""
    n, lanes = e.shape[:2]
    across = step[None, :, :] + e[0][:, None, :]
    for row in e[1:]:
        across = _best(across[:, :, 0:1] + step[0], across[:, :, 1:2] + step[1], across[:, :, 2:3] + step[2]) + row[:, None, :]
    best = np.empty((lanes, 3))
    for i in range(lanes):
        best[i] = entry
        entry = (entry[:, None] + across[i]).max(axis=0)
    back = np.empty((n, lanes, 3), np.int8)
    for t, row in enumerate(e):
        paths = best[:, 0:1] + step[0], best[:, 1:2] + step[1], best[:, 2:3] + step[2]
        best = _best(*paths)
        back[t] = np.where(paths[0] == best, 0, np.where(paths[1] == best, 1, 2))
        best += row
    tags, at = np.empty((n, lanes, 3), np.int8), np.tile(np.arange(3), (lanes, 1))
    for t in range(n - 1, -1, -1):
        tags[t] = at
        at = np.take_along_axis(back[t], at, axis=1).astype(np.int64)
    return tags, at, best[-1] - best[-1].max()


def viterbi(scores: Iterable[np.ndarray], step: np.ndarray) -> np.ndarray:
    """The best tags of a chain, outside on both ends, whose scores (n, 3) come in blocks; three bytes a token are kept."""
    best, done = np.array([0.0, -np.inf, -np.inf]), []
    for block in scores:
        whole = len(block) // LANE * LANE
        for part, steps in ((block[:whole], LANE), (block[whole:], len(block) - whole)):
            if len(part):
                tags, before, best = _lanes(np.ascontiguousarray(part.reshape(-1, steps, 3).swapaxes(0, 1)), step, best)
                done.append((tags, before))
    out, state = [], int((best + step[:, OUTSIDE]).argmax())
    for tags, before in reversed(done):
        ends = np.empty(len(before), np.int64)
        for i in range(len(before) - 1, -1, -1):
            ends[i] = state
            state = int(before[i, state])
        out.append(tags[:, np.arange(len(ends)), ends].T.ravel())
    return np.concatenate(out[::-1]) if out else np.empty(0, np.int8)


class Field:
    """Weights of features by tag and of neighbouring tags; outside to inside is ruled out."""

    def __init__(self, emit: np.ndarray, step: np.ndarray):
        self.emit, self.step = emit, step

    def scores(self, feats: list[np.ndarray]) -> np.ndarray:
        return np.stack([self.emit[f].sum(axis=0) for f in feats])

    def decode(self, feats: list[np.ndarray]) -> list[int]:
        return viterbi([self.scores(feats)], self.step).tolist()

    def marginals(self, feats: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """P(tag of each token), and expected counts of neighbouring tags with the outside ends."""
        tags, steps = _expected(self.scores(feats)[None], self.step)
        return tags[0], steps


def _expected(e: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For chains with scores (chains, n, 3): P(tag), and the expected counts of neighbouring tags over all of them."""
    n, s = e.shape[1], np.exp(step)
    e = np.exp(e - e.max(axis=2, keepdims=True))
    ahead, behind = np.empty_like(e), np.empty_like(e)
    ahead[:, 0] = s[OUTSIDE] * e[:, 0]
    ahead[:, 0] /= ahead[:, 0].sum(axis=1, keepdims=True)
    for i in range(1, n):
        a = (ahead[:, i - 1] @ s) * e[:, i]
        ahead[:, i] = a / a.sum(axis=1, keepdims=True)
    behind[:, -1] = s[:, OUTSIDE]
    for i in range(n - 2, -1, -1):
        b = (e[:, i + 1] * behind[:, i + 1]) @ s.T
        behind[:, i] = b / b.sum(axis=1, keepdims=True)
    tags = ahead * behind
    tags /= tags.sum(axis=2, keepdims=True)
    pairs = ahead[:, :-1, :, None] * s * (e[:, 1:] * behind[:, 1:])[:, :, None, :]
    steps = (pairs / pairs.sum(axis=(2, 3), keepdims=True)).sum(axis=(0, 1))
    steps[OUTSIDE] += tags[:, 0].sum(axis=0)
    steps[:, OUTSIDE] += tags[:, -1].sum(axis=0)
    return tags, steps


NONE = 1 << BITS              # the feature of a place that has none


def fit(feats: np.ndarray, tags: np.ndarray, epochs: int = 10, rate: float = 0.3, decay: float = 1e-4, seed: int = 7,
        batch: int = 128) -> Field:
    """Maximum likelihood with a small L2 penalty, by AdaGrad over batches of chains in seeded order.

    ``feats``: (chains, tokens, features), NONE where there is none; ``tags``: (chains, tokens), -1 behind a chain's end."""
    emit, step = np.zeros((NONE + 1, 3)), np.zeros((3, 3))
    step[OUTSIDE, INSIDE] = -1e3
    free = step > -1
    grown_e, grown_s, rng = np.full((NONE + 1, 3), 1e-8), np.full((3, 3), 1e-8), np.random.default_rng(seed)
    for _ in range(epochs):
        order = rng.permutation(len(tags))
        for at in range(0, len(order), batch):
            f, t = feats[order[at:at + batch]], tags[order[at:at + batch]]
            n = int((t >= 0).sum(axis=1).max())
            f, t = f[:, :n], t[:, :n]
            real, t = t >= 0, np.maximum(t, OUTSIDE)
            # Behind its end a chain stays outside, in what is seen and in what is expected.
            e = np.where(real[:, :, None], emit[f].sum(axis=2), [0.0, -np.inf, -np.inf])
            p, steps = _expected(e, step)
            g = (np.eye(3)[t] - p) * real[:, :, None]
            flat = f.reshape(-1)
            g = np.stack([np.bincount(flat, np.repeat(g[:, :, k].ravel(), f.shape[2]), NONE + 1) for k in range(3)], axis=1)
            g -= decay * len(t) * emit
            g[NONE] = 0
            grown_e += g * g
            emit += rate * g / np.sqrt(grown_e)
            path = np.pad(t, ((0, 0), (1, 1)), constant_values=OUTSIDE)
            seen = np.bincount((path[:, :-1] * 3 + path[:, 1:]).ravel(), minlength=9).reshape(3, 3)
            g = np.where(free, seen - steps - decay * len(t) * step, 0.0)
            grown_s += g * g
            step += rate * g / np.sqrt(grown_s)
    return Field(emit[:NONE], step)


ALONE = -1                    # the tag, in the copy without neighbours, of a token that it does not have


def examples_of(text: str) -> Iterator[tuple[list[list[int]], list[int], list[int]]]:
    """Chains of ``text``: features, the tags for the copy without neighbours, and the tags.

    A token that a base span reaches into is secret; of a span, the copy has the last token alone (the value of an
    assignment).  All chains with a secret, a numbered token of 8 characters or more or one of 24 are learnt from, of the
    others one in TRAIN_SHARE."""
    spans, passed, inside, before = base_spans(text), 0, None, ["", ""]
    file, matches = file_features(text), TOKEN.finditer(text)
    part = list(islice(matches, TRAIN_TOKENS))
    while part:
        behind = list(islice(matches, TRAIN_TOKENS))
        words, tags, alone = [m.group() for m in part], [], []
        for m in part:
            a, b = m.span()
            while passed < len(spans) and spans[passed][2] <= a:    # ends before all later tokens too
                passed += 1
            hit, at = None, passed
            while hit is None and at < len(spans) and spans[at][1] < b:
                hit = spans[at] if a < spans[at][2] else None
                at += 1
            tags.append(OUTSIDE if hit is None else INSIDE if hit == inside else BEGIN)
            alone.append(OUTSIDE if hit is None else BEGIN if b >= hit[2] else ALONE)
            inside = hit
        if any(tags) or any(len(w) >= 24 or len(w) >= 8 and DIGITS.search(w) for w in words) \
                or zlib.crc32(" ".join(words).encode("utf-8", "surrogatepass")) % TRAIN_SHARE == 0:
            tags[0] = BEGIN if tags[0] == INSIDE else tags[0]
            around = [near_features(w) for w in (*before, *words, behind[0].group() if behind else "")]
            yield [[*own_features(w), around[i + 1][0], around[i][1], around[i + 3][2], *file] for i, w in enumerate(words)], alone, tags
        before, part = [*before, *words][-2:], behind


def apart(more: list[tuple[str, int, int]], spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Those of ``more`` that none of ``spans`` (sorted by start) touches."""
    starts, reach = [s[1] for s in spans], list(accumulate((s[2] for s in spans), max))
    first = [bisect_left(starts, s[2]) for s in more]    # spans that start before the end
    return [s for s, n in zip(more, first) if n == 0 or reach[n - 1] <= s[1]]


def copies_of(feats: np.ndarray, tags: np.ndarray, moved: int, plain: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Copies of a chain: one without neighbours and file, and some whose secrets stand where other tokens do."""
    if plain:
        out = feats.copy()
        out[:, OWN:] = NONE
        yield out, tags
    others = np.flatnonzero(tags == OUTSIDE)
    if len(others):
        for i in range(moved):
            out = feats.copy()
            for at in np.flatnonzero(tags):
                out[at, OWN:] = feats[others[(7 * at + 5 * i) % len(others)], OWN:]
            yield out, tags


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, max_chains: int = MAX_CHAINS,
          text_col: str = "text", order_col: str = "doc_id") -> Field | None:
    """The field from about ``sample_docs`` documents (by hash of ``order_col``) and at most
    ``max_chains`` chains of them; None if no chain holds a secret."""
    total = docs.count()
    share = F.pmod(F.xxhash64(F.col(order_col), F.lit("secrets")), F.lit(1 << 30)) / float(1 << 30)
    rows = docs.where(share < sample_docs / max(total, 1)).select(F.col(text_col).cast("string").alias("text")).where("text is not null")

    def tagged(batches):
        for batch in batches:
            for text in batch.column("text").to_pylist():
                found = [(np.array(feats, np.int16).tobytes(), np.array([alone, tags], np.int8).tobytes())
                         for feats, alone, tags in examples_of(text)]
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.binary()) for i in (0, 1)], ["feats", "tags"])
    found = rows.mapInArrow(tagged, "feats binary, tags binary")
    found = found.withColumn("h", F.xxhash64("feats", "tags")).orderBy("h").limit(max_chains).collect()
    chains = [(np.frombuffer(r["feats"], np.int16).reshape(-1, OWN + NEAR + FILE), *np.frombuffer(r["tags"], np.int8).reshape(2, -1), r["h"])
              for r in found]
    secret = sum(bool(t.any()) for _, _, t, _ in chains)
    copies = min(max(COPIES // max(secret, 1), 1), 16)
    feats, tags = [], []
    for f, alone, t, h in chains:
        feats.append(f)
        tags.append(t)
        for f, t in copies_of(f[alone != ALONE], alone[alone != ALONE], copies if t.any() else 0, h % 2 or t.any()):
            feats.append(f)
            tags.append(t)
    if not any(t.any() for t in tags):
        return None
    all_feats = np.full((len(tags), TRAIN_TOKENS, OWN + NEAR + FILE), NONE, np.int16)
    all_tags = np.full((len(tags), TRAIN_TOKENS), -1, np.int8)
    for i, (f, t) in enumerate(zip(feats, tags)):
        all_feats[i, :len(t)], all_tags[i, :len(t)] = f, t
    return fit(all_feats, all_tags, batch=min(max(len(tags) // 200, 16), 128))


# ---- scanning -----------------------------------------------------------------------------

class _Known(dict):
    """Numbers of tokens in order of their first look-up; ``new`` lists those without scores yet."""

    def __init__(self):
        super().__init__()
        self.new = []

    def __missing__(self, token: str) -> int:
        at = self[token] = len(self)
        self.new.append(token)
        return at


class Scanner:
    """All spans of texts: the base spans, and those of the field that no base span touches.

    What a token adds to its own scores and to its neighbours' is looked up by the token."""

    def __init__(self, field: Field | None):
        self.field = field
        if field is not None:
            self.known, self.forms, self.chars, self.table = _Known(), {}, 0, np.empty((KNOWN_TOKENS, 12))
            self.none = np.concatenate([np.zeros(3), *[field.emit[f] for f in near_features("")]])

    def _rows(self, words: list[str]) -> np.ndarray:
        """Own scores of every token, and what it adds to the next, the next but one and the one before."""
        out = []
        for at in range(0, len(words), PART_TOKENS):
            part = words[at:at + PART_TOKENS]
            if len(self.known) + len(part) > KNOWN_TOKENS or self.chars > KNOWN_CHARS:
                self.known, self.forms, self.chars = _Known(), {}, 0
            old = len(self.known)
            ids = list(map(self.known.__getitem__, part))
            if len(self.known) > old:
                self._learn(self.known.new, old)
                self.known.new = []
            out.append(self.table[ids])
        return out[0] if len(out) == 1 else np.concatenate(out)

    def _learn(self, words: list[str], at: int) -> None:
        emit, own = self.field.emit, []
        for w in words:
            kind = form(w)
            if kind not in self.forms:
                self.forms[kind] = emit[form_features(kind)].sum(axis=0)
            own.append(self.forms[kind])
        rows = self.table[at:at + len(words)]
        rows[:, :3] = np.array(own) + emit[[head_feature(w) for w in words]]
        rows[:, 3:] = emit[[near_features(w) for w in words]].reshape(-1, 9)
        self.chars += sum(map(len, words))

    def _scores(self, text: str) -> Iterator[np.ndarray]:
        """The scores (n, 3) of the tokens of ``text``, in parts."""
        file, none = self.field.emit[file_features(text)].sum(axis=0), self.none[None]
        before = np.concatenate([none, none])
        parts = token_parts(text)
        rows = next((self._rows(words) for words in parts), None)
        while rows is not None:
            behind = next((self._rows(words) for words in parts), None)
            around = np.concatenate([before, rows, none if behind is None else behind[:1]])
            yield rows[:, :3] + around[1:-2, 3:6] + around[:-3, 6:9] + around[3:, 9:12] + file
            before, rows = around[-3:-1], behind

    def _tags(self, texts: list[str]) -> list[np.ndarray]:
        """The tags of every text's tokens: one chain, with a token between texts that is outside."""
        counts, apart_ = [0] * len(texts), np.array([[0.0, -np.inf, -np.inf]])

        def blocks():
            held, size = [], 0
            for i, text in enumerate(texts):
                for e in self._scores(text):
                    counts[i] += len(e)
                    held.append(e)
                    size += len(e)
                    if size >= LANE * LANES:
                        block = np.concatenate(held)
                        yield block
                        held, size = [], 0
                held.append(apart_)
                size += 1
            yield np.concatenate(held)
        tags, out, at = viterbi(blocks(), self.field.step), [], 0
        for n in counts:
            out.append(tags[at:at + n])
            at += n + 1
        return out

    def _found(self, text: str, tags: np.ndarray) -> Iterator[tuple[str, int, int]]:
        if not tags.any():
            return
        start = end = None
        for m, tag in zip(TOKEN.finditer(text), tags.tolist()):
            if tag == INSIDE and start is not None:
                end = m.end()
                continue
            if start is not None:
                yield "crf", start, end
            start, end = m.span() if tag == BEGIN else (None, None)
        if start is not None:
            yield "crf", start, end

    def scan(self, texts: list[str | None]) -> Iterator[list[tuple[str, int, int]]]:
        """The spans of every text, in the order of ``texts``."""
        group, size = [], 0
        for text in texts:
            group.append(text or "")
            size += len(group[-1]) // 6 + 1
            if size >= GROUP_TOKENS:
                yield from self._scan(group)
                group, size = [], 0
        if group:
            yield from self._scan(group)

    def _scan(self, texts: list[str]) -> Iterator[list[tuple[str, int, int]]]:
        if self.field is None:
            yield from map(base_spans, texts)
            return
        for text, tags in zip(texts, self._tags(texts)):
            spans = base_spans(text)
            more = apart(list(self._found(text, tags)), spans)
            yield sorted(spans + more, key=lambda s: (s[1], KINDS.index(s[0]), s[2])) if more else spans


def scan(text: str | None, field: Field | None) -> list[tuple[str, int, int]]:
    """All spans of a text: the base spans, and those of the field that no base span touches."""
    return next(Scanner(field).scan([text]))


SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"


def scanner_of(docs: DataFrame, field: Field | None) -> Callable[[], Scanner]:
    """One scanner a task, made at its first use."""
    held, made = docs.sparkSession.sparkContext.broadcast(field), []

    def scanner() -> Scanner:
        if not made:
            made.append(Scanner(held.value))
        return made[0]
    return scanner


def text_parts(batches: Iterable[pa.Array]) -> Iterator[list[str | None]]:
    for texts in batches:
        for at in range(0, len(texts), PART_TEXTS):
            yield texts.slice(at, PART_TEXTS).to_pylist()


def cleaned_parts(scanner: Callable[[], Scanner], batches: Iterable[pa.Array]) -> Iterator[pa.Array]:
    """The texts of ``batches`` with a mark for every secret, in smaller batches."""
    for rows in text_parts(batches):
        yield pa.array([None if t is None else redact(t, [(a, b) for _, a, b in spans])
                        for t, spans in zip(rows, scanner().scan(rows))], pa.string())


def spans_column(field: Field | None, docs: DataFrame, text: Column) -> Column:
    scanner = scanner_of(docs, field)

    def scanned(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in text_parts(batches):
            rows = [[{"kind": k, "start": a, "end": b} for k, a, b in spans] for spans in scanner().scan(texts)]
            yield pa.array(rows, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))
    return F.arrow_udf(scanned, SPANS)(text)


def secrets(docs: DataFrame) -> DataFrame:
    """``(doc_id, secrets)``: the spans of every row as an array of (kind, start, end) in code
    points, end exclusive.  A null text is empty and has none; rows that repeat are scanned each;
    where no document of the sample holds a secret, the base patterns work alone."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select("doc_id", spans_column(train(docs), docs, text).alias("secrets"))


def redact(text: str | None, spans: list[tuple[int, int]], mark: str = "[SECRET]") -> str | None:
    if not spans:
        return text
    out, at = [], 0
    for a, b in sorted(spans):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame) -> DataFrame:
    """The documents with every secret of their texts replaced by a mark (``n_chars``, if there, set anew)."""
    scanner, name = scanner_of(docs, train(docs)), free_name(docs, "_clean")

    def cleaned(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return cleaned_parts(scanner, batches)
    out = docs.withColumn(name, F.arrow_udf(cleaned, "string")(F.col("text").cast("string")))
    kinds = dict(docs.dtypes)
    new = {"text": F.col(name).alias("text")}
    if "n_chars" in kinds:
        n = F.length(name).cast(kinds["n_chars"])
        new["n_chars"] = F.when(F.col(name).eqNullSafe(F.col("text")), F.col("n_chars")).otherwise(n).alias("n_chars")
    return out.select(*[new.get(c, F.col(c)) for c in docs.columns])
