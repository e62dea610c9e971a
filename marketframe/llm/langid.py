"""Language identification by cross-parsing entropy.

Per language, a suffix automaton of labelled text gives longest matches: a text is parsed greedily into the longest
phrases that occur in the language's text, and the language whose phrases cost least, ``phrases * log2(size of
its text) / characters``, wins (ties go to the smaller label).

The automata are fitted on a bounded sample: at most ``sample_docs`` labelled documents a language (of each class of text
hashes modulo that number the smallest, equal texts once), ``sample_chars`` characters of each. Every text is then parsed whole, in blocks of ``BLOCK``
characters over whose ends no phrase runs, all blocks of a batch in step: where an automaton has no move, a new phrase begins. Its moves are kept
in a displacement table (the rows of all states laid over each other, each move with its owner), whose size follows the number of moves
and not the alphabet's, so the alphabet is all letters of the sample, in whatever scripts.

Defined cases: a null or empty text, or one without a letter, is ``und`` with score 0. Rows with a null label,
text or (for ``held_out``) id are not learned from. Without any labelled text all texts are ``und``. Repeated
rows are predicted alike. Case, digits, punctuation and runs of them don't count. Letters that a language's sample doesn't hold are phrases of
their own in it. Extra columns are kept by ``predict``; ``lang_pred`` and ``score`` are replaced.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketframe.llm.automaton import SuffixAutomaton

BLOCK = 1024
PIECE = 2_000_000
OTHER, GAP = 0, 1
MARGIN = 1.25
_built: dict = {}


def held_out(id_col: str = "doc_id") -> Column:
    """Documents kept for tests: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", sample_docs: int = 64, sample_chars: int = 512) -> dict[str, list[str]]:
    """A bounded sample of texts by label, on the driver."""
    rows = docs.select(F.col(lang_col).alias("l"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("t")).where(F.col("l").isNotNull() & F.col("t").rlike(r"\p{L}"))
    chosen = [r.h for r in rows.groupBy("l", F.pmod("h", F.lit(sample_docs)).alias("slot")).agg(F.min("h").alias("h")).select("h").distinct().collect()]
    texts: dict[str, set] = {}
    if chosen:
        for r in rows.where(F.col("h").isin(chosen)).groupBy("l", "h").agg(F.min(F.substring("t", 1, sample_chars)).alias("t")).collect():
            texts.setdefault(r.l, set()).add(r.t)
    return {lang: sorted(t)[:sample_docs] for lang, t in sorted(texts.items())}


@lru_cache(4)
def _classes(alphabet: str) -> tuple[np.ndarray, np.ndarray]:
    """Of each code point: its symbol, and whether it is a letter."""
    place = {c: i for i, c in enumerate(alphabet, GAP + 1)}
    symbol, letter = np.full(0x110000, GAP, np.int32), np.zeros(0x110000, bool)
    for cp in range(0x110000):
        c = chr(cp)
        if c.isalpha():
            letter[cp] = True
            symbol[cp] = place.get(c.lower()[0], OTHER)
    return symbol, letter


def _symbols(texts: list[str], alphabet: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all texts with runs of gaps as one, the number of symbols of each text, and its number of letters."""
    code, letter = _classes(alphabet)
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(size)
    s = code[points]
    keep = np.ones(len(s), bool)
    keep[1:] = (s[1:] != GAP) | (s[:-1] != GAP)
    first = (ends - size)[size > 0]
    keep[first] = True
    total = lambda x: np.diff(np.concatenate([[0], np.concatenate([[0], np.cumsum(x)])[ends]]))
    return s[keep], total(keep), total(letter[points])


class Parser:
    """The automata of all languages, as tables."""

    def __init__(self, texts: dict[str, list[str]]):
        self.alphabet = "".join(sorted({c.lower()[0] for t in texts.values() for x in t for c in x if c.isalpha()}))
        self.langs, self.tables, self.bits = [], [], []
        for lang, samples in texts.items():
            s, n, _ = _symbols(samples, self.alphabet)
            if len(s):
                self.langs.append(lang)
                self.tables.append(self._table(SuffixAutomaton(x.tolist() for x in np.split(s, np.cumsum(n)[:-1]))))
                self.bits.append(math.log2(1 + len(s)))

    def _table(self, sam: SuffixAutomaton) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The root's moves by symbol (0: none); of each other state its base; of each place the state whose move stands there, and the next
        state. State s moves by c if place ``base[s] + c`` (modulo the number of places) is its own."""
        width = len(self.alphabet) + GAP + 1
        root = np.zeros(width, np.int32)
        for c, t in sam.go[0].items():
            root[c] = t
        moves = sum(map(len, sam.go[1:]))
        many = sorted((s for s in range(1, len(sam)) if len(sam.go[s]) > 1), key=lambda s: -len(sam.go[s]))
        one = [s for s in range(1, len(sam)) if len(sam.go[s]) == 1]
        places = 1 << max(2 * moves, width).bit_length()
        while (found := self._bases(sam, many, places)) is None:
            places *= 2
        base, used = np.zeros(len(sam), np.int32), np.frombuffer(found[1], np.uint8)
        base[many] = found[0]
        sym = np.fromiter((c for s in one for c in sam.go[s]), np.int64, len(one))
        base[one] = (np.flatnonzero(used == 0)[: len(one)] - sym) & (places - 1)
        state = np.repeat(np.arange(1, len(sam)), [len(g) for g in sam.go[1:]])
        at = (base[state] + np.fromiter((c for g in sam.go[1:] for c in g), np.int64, moves)) & (places - 1)
        owner, to = np.full(places, -1, np.int32), np.zeros(places, np.int32)
        owner[at] = state
        to[at] = np.fromiter((t for g in sam.go[1:] for t in g.values()), np.int64, moves)
        return root, base, owner, to

    @staticmethod
    def _bases(sam: SuffixAutomaton, states: list[int], places: int) -> tuple[list[int], bytearray] | None:
        """Bases at which no two moves of the states meet, and the places used; none if there aren't any."""
        used, out, base, mask = bytearray(places), [], 0, places - 1
        for s in states:
            row = list(sam.go[s])
            for _ in range(places):
                base = (base + 0x9E3779B1) & mask  # odd: every base is tried
                if not any(used[(base + c) & mask] for c in row):
                    break
            else:
                return None
            for c in row:
                used[(base + c) & mask] = 1
            out.append(base)
        return out, used

    def phrases(self, s: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Number of phrases of each text (rows) in each language (columns)."""
        out = np.zeros((len(n), len(self.langs)), np.int64)
        if not len(s):
            return out
        blocks = -(-n // BLOCK)
        owner = np.repeat(np.arange(len(n)), blocks)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        start = np.repeat(np.cumsum(n) - n, blocks) + nth * BLOCK
        size = np.minimum(BLOCK, np.repeat(n, blocks) - nth * BLOCK)
        order = np.argsort(-size, kind="stable")
        start, size, owner = start[order], size[order], owner[order]
        active = np.searchsorted(-size, -np.arange(size[0]), "left")  # blocks longer than j
        state, count = np.zeros((2, len(self.langs), len(start)), np.int32)
        for j, m in enumerate(active.tolist()):
            c = s.take(start[:m] + j)
            for k, (root, base, own, to) in enumerate(self.tables):
                at = state[k, :m]
                place = (base.take(at) + c) & (len(own) - 1)
                new = own.take(place) != at
                count[k, :m] += new
                state[k, :m] = np.where(new, root.take(c), to.take(place))
        for k in range(len(self.langs)):
            out[:, k] = np.bincount(owner, count[k], len(n))
        return out

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Label, score, and phrases a character of the label's parse, of each text."""
        s, n, letters = _symbols(texts, self.alphabet)
        if not self.langs:
            return ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts))
        found = self.phrases(s, n)
        cost = found * np.array(self.bits)
        best = cost.argmin(1)
        ranked = np.sort(cost, 1)
        with np.errstate(divide="ignore", invalid="ignore"):
            score = 1 - ranked[:, 0] / ranked[:, 1] if ranked.shape[1] > 1 else np.ones(len(texts))
            rate = found[np.arange(len(texts)), best] / n
        known = letters > 0
        return [self.langs[b] if ok else "und" for b, ok in zip(best.tolist(), known.tolist(), strict=True)], np.where(known, score, 0.0), np.where(known, rate, 1.0)


def own_rate(samples: list[str]) -> float:
    """Phrases a character of the second half of a language's sample, parsed by the first."""
    text = "\n".join(samples)
    return float(Parser({"": [text[: len(text) // 2]]}).predict([text[len(text) // 2 :]])[2][0])


def _parser(key: str, bc) -> Parser:
    """A worker's tables; kept for its next tasks."""
    if key not in _built:
        _built.clear()
        _built[key] = Parser(bc.value)
    return _built[key]


def predict(docs: DataFrame, texts: dict[str, list[str]], *, text_col: str = "text", drop_text: bool = False) -> DataFrame:
    """``docs`` with lang_pred, score (0 to 1: how much the second language's parse costs more) and phrase_rate
    (phrases a character, 1 for ``und``); without the texts, if they are to be dropped."""
    bc = docs.sparkSession.sparkContext.broadcast(texts)
    key = uuid.uuid4().hex
    docs = docs.drop("lang_pred", "score", "phrase_rate")
    kept = [f for f in docs.schema if not (drop_text and f.name == text_col)]
    schema = T.StructType([*kept, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("phrase_rate", T.DoubleType())])
    names = [f.name for f in kept]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = _parser(key, bc)
        for batch in batches:
            for rows in _slices(batch, text_col):
                langs, scores, rates = parser.predict([t or "" for t in rows.column(text_col).to_pylist()])
                yield pa.RecordBatch.from_arrays([*[rows.column(c) for c in names], pa.array(langs, pa.string()), pa.array(scores), pa.array(rates)], names=[*names, "lang_pred", "score", "phrase_rate"])

    return docs.mapInArrow(step, schema)


def _slices(batch: pa.RecordBatch, text_col: str) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``PIECE`` bytes of text, or one text."""
    ends = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    i = 0
    while i < batch.num_rows:
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + PIECE, "right")))
        yield batch.slice(i, j - i)
        i = j


def keep_known(docs: DataFrame, texts: dict[str, list[str]], *, text_col: str = "text", max_rate: float = 0.5, least_chars: int = 20) -> DataFrame:
    """The rows of ``docs`` in a learned language. Rejected are texts that are ``und``, and those of at least ``least_chars`` characters with
    more than ``max_rate`` phrases a character: random letters take over 0.6, a language of few letters less than 0.4. In one of many letters
    phrases are shorter; there, the limit is ``MARGIN`` times the language's own rate."""
    names = docs.columns
    limit = F.lit(max_rate)
    for lang, samples in texts.items():
        if (own := MARGIN * own_rate(samples)) > max_rate:
            limit = F.when(F.col("lang_pred") == lang, own).otherwise(limit)
    rows = predict(docs.select(F.struct(*[F.col(f"`{c}`") for c in names if c != text_col]).alias("row"), F.col(f"`{text_col}`").alias("text")), texts)
    known = (F.col("lang_pred") != "und") & ((F.col("phrase_rate") <= limit) | (F.length("text") < least_chars))
    return rows.where(known).select(*[(F.col("text") if c == text_col else F.col("row")[c]).alias(c) for c in names])
