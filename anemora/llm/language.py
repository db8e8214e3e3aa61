"""Language identification by a linear-chain conditional random field over words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anemora.llm.common import Words, free_name, mix, slices, text_bytes

UNKNOWN = "und"

#: Hashed features of affixes and n-grams, and the most frequent words of the sample, which have a feature each.
FEATURES = 1 << 15
LEXICON = 4_096
#: The training sample: documents of a language, runs taken from each, words of a run.
DOCUMENTS, RUNS, RUN_WORDS = 250, 4, 20
#: Documents of all languages together; many languages share them, down to ``FEWEST`` each, so that every language is learned.
SAMPLE, FEWEST = 4_000, 16
#: Numbers in one array of training or scoring; chains and texts are taken in pieces of this size.
CELLS = 1 << 22

_OTHER = np.ones(256, bool)
_OTHER[ord("A"):ord("Z") + 1] = _OTHER[ord("a"):ord("z") + 1] = _OTHER[128:] = False
_SEGMENT = 32


def letters(raw: np.ndarray, offsets: np.ndarray) -> Words:
    """Runs of letters (bytes above 127 count as such), in lower case for Latin letters up to U+00DE."""
    raw = np.where((raw >= 65) & (raw <= 90), raw + np.uint8(32), raw)
    if len(raw) > 1:
        capital = (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[1:] != 0x97)
        raw[1:][capital] += np.uint8(32)
    return Words(raw, offsets, _OTHER)


def _features(words: Words, which: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Hashed features of some words: ``(feature, first index of each word)`` for byte pairs, triples, prefixes and suffixes."""
    start, size = words.start[which], (words.end - words.start)[which]
    room = size + 2
    first = np.cumsum(room) - room
    text = np.full(int(room.sum()) + 3, 32, np.uint64)
    inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    text[np.repeat(first + 1, size) + inside] = words.raw[np.repeat(start, size) + inside]
    total = int(room.sum())
    pairs = text[:total] | text[1:total + 1] << np.uint64(8)
    triples = pairs | text[2:total + 2] << np.uint64(16)
    out = []
    for n, code in ((2, pairs), (3, triples)):
        count = room + 1 - n
        at = np.repeat(first, count) + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        out.append((_slot(code[at], n), np.cumsum(count) - count))
    each = np.arange(len(which))
    for salt, back in ((4, False), (5, True)):
        code = np.zeros(len(which), np.uint64)
        for k in range(4):
            at = first + (size - k if back else 1 + k)
            code |= np.where(k < size, text[np.maximum(at, 0)], 0).astype(np.uint64) << np.uint64(8 * k)
        out.append((_slot(code, salt), each))
    return out


def _slot(code: np.ndarray, salt: int) -> np.ndarray:
    return (mix(code + np.uint64(salt << 40)) % np.uint64(FEATURES)).astype(np.int64)


@dataclass(frozen=True)
class Model:
    """Labels, feature weights (hashed, then lexicon words), transition scores, and the lexicon's word hashes in order."""

    labels: tuple[str, ...]
    weights: np.ndarray
    moves: np.ndarray
    lexicon: np.ndarray

    def emissions(self, words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores of the distinct words, and each word's number among them."""
        _, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        scores = np.zeros((len(first), len(self.labels)), np.float32)
        for feature, begins in _features(words, first):
            scores += np.add.reduceat(self.weights[feature], begins, axis=0)
        known, rank = _look_up(self.lexicon, hashes[first])
        scores[known] += self.weights[FEATURES + rank[known]]
        return scores, inverse

    def shares(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Expected share of each label among a text's words, by forward-backward; words per text."""
        words = letters(raw, offsets)
        out = np.zeros((len(offsets) - 1, len(self.labels)))
        if len(words):
            scores, inverse = self.emissions(words, words.hashes())
            potential = np.exp(scores - scores.max(axis=1, keepdims=True)).astype(np.float64)
            posterior = marginals(potential[inverse], np.exp(self.moves.astype(np.float64)), words.counts)
            some = np.flatnonzero(words.counts)
            out[some] = np.add.reduceat(posterior, words.first[some], axis=0) / words.counts[some, None]
        return out, words.counts


def _look_up(ordered: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(ordered):
        return np.zeros(len(values), bool), np.zeros(len(values), np.int64)
    rank = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[rank] == values, rank


def marginals(potential: np.ndarray, moves: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Posterior of each word's label in chains of ``counts`` words, one after the other.

    Chains are cut into segments.  The product of a segment's steps is one small matrix, made for all
    segments at once; chains then run over segments instead of words, and the
    words inside are filled in from both ends.
    """
    labels = potential.shape[1]
    counts = np.asarray(counts)
    pieces = -(-counts // _SEGMENT)
    total = int(pieces.sum())
    chain = np.repeat(np.arange(len(counts)), pieces)
    number = np.arange(total) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = (np.cumsum(counts) - counts)[chain] + number * _SEGMENT
    length = np.minimum(_SEGMENT, counts[chain] - number * _SEGMENT)
    # A chain's first word has no move before it; that equals uniform weights before a matrix of ones.
    steps = []
    for k in range(_SEGMENT):
        on = k < length
        steps.append((on, potential[np.where(on, begin + k, 0)]))
    opening = number == 0

    def push(vectors: np.ndarray, k: int) -> np.ndarray:
        on, weight = steps[k]
        moved = vectors @ moves
        if k == 0:
            moved = np.where(_wide(opening, moved), vectors.sum(axis=-1, keepdims=True), moved)
        moved = moved * (weight[:, None, :] if moved.ndim == 3 else weight)
        return np.where(_wide(on, moved), moved, vectors)

    across = np.broadcast_to(np.eye(labels), (total, labels, labels)).copy()
    for k in range(_SEGMENT):
        across = push(across, k)
        across /= across.sum(axis=(1, 2), keepdims=True)
    base = np.cumsum(pieces) - pieces
    ahead, behind = np.full((total, labels), 1.0 / labels), np.full((total, labels), 1.0 / labels)
    longest = int(pieces.max(initial=0))
    order = np.argsort(-pieces, kind="stable")
    active = np.searchsorted(-pieces[order], -np.arange(1, longest + 2), side="right")
    for s in range(1, longest):
        at = base[order[:active[s]]] + s
        value = np.einsum("ni,nij->nj", ahead[at - 1], across[at - 1])
        ahead[at] = value / value.sum(axis=1, keepdims=True)
    for s in range(longest - 2, -1, -1):
        at = base[order[:active[s + 1]]] + s
        value = np.einsum("nij,nj->ni", across[at + 1], behind[at + 1])
        behind[at] = value / value.sum(axis=1, keepdims=True)
    forward, state = [], ahead
    for k in range(_SEGMENT):
        state = push(state, k)
        state = state / state.sum(axis=1, keepdims=True)
        forward.append(state)
    out = np.empty_like(potential)
    state = behind
    for k in range(_SEGMENT - 1, -1, -1):
        on, weight = steps[k]
        value = forward[k] * state
        value /= value.sum(axis=1, keepdims=True)
        out[begin[on] + k] = value[on]
        pulled = (weight * state) @ moves.T
        state = np.where(on[:, None], pulled / pulled.sum(axis=1, keepdims=True), state)
    return out


def _wide(flags: np.ndarray, like: np.ndarray) -> np.ndarray:
    return flags.reshape(-1, *[1] * (like.ndim - 1))


# --- training ---


def sample_runs(docs: DataFrame, per_label: int = DOCUMENTS, runs: int = RUNS, run_words: int = RUN_WORDS) -> list[tuple[str, str]]:
    """``(lang, words)``: runs of words spread over whole texts, from about ``per_label`` documents of each language.

    ``docs`` has ``key, text, lang``.  Documents are drawn by a hash of their key; only the runs reach the driver.  Every language is
    drawn from; above ``SAMPLE / per_label`` languages each gives fewer documents.
    """
    sizes = docs.groupBy("lang").count().collect()
    if not sizes:
        return []
    per_label = min(per_label, max(FEWEST, SAMPLE // len(sizes)))
    # A language of few documents gives all of them, so none is missed by chance.
    parts = docs.sparkSession.createDataFrame([(lang, min(1.0, per_label / n) if n > FEWEST else 1.0) for lang, n in sizes], "of string, part double")
    drawn = docs.join(F.broadcast(parts), F.col("lang") == F.col("of")).where(
        F.pmod(F.xxhash64("key", F.lit("sample")), F.lit(1_000_000)) < F.col("part") * 1_000_000)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text", 4 << 20):
                words = letters(*text_bytes(piece.column("text")))
                raw = words.raw.tobytes()
                labels, found = [], []
                for d, lang in enumerate(piece.column("lang").to_pylist()):
                    n, first = int(words.counts[d]), int(words.first[d])
                    for begin in sorted({k * max(0, n - run_words) // max(1, runs - 1) for k in range(runs)}) if n else []:
                        some = range(first + begin, first + min(n, begin + run_words))
                        found.append(" ".join(raw[words.start[w]:words.end[w]][:64].decode("utf-8", "ignore") for w in some))
                        labels.append(lang)
                yield pa.RecordBatch.from_arrays([pa.array(labels, pa.string()), pa.array(found, pa.string())], ["lang", "words"])

    return sorted(tuple(r) for r in drawn.select("lang", "text").mapInArrow(work, "lang string, words string").collect())


def fit(runs: list[tuple[str, str]], rounds: int = 40, rate: float = 0.3, decay: float = 1e-4, seed: int = 1) -> Model:
    """Maximise the likelihood of label sequences over chains of runs.

    Chains join runs of other documents, every other time of another language, so that moves between languages are
    learned from code-switched text.
    """
    labels = tuple(sorted({lang for lang, words in runs if words.strip()}))
    runs = [(labels.index(lang), words) for lang, words in runs if words.strip()]
    if not runs:
        return Model((), np.zeros((0, 0), np.float32), np.zeros((0, 0), np.float32), np.zeros(0, np.uint64))
    random = np.random.default_rng(seed)
    by_label = [[i for i, (y, _) in enumerate(runs) if y == k] for k in range(len(labels))]
    chains = []
    for i in random.permutation(len(runs)):
        other = runs[i][0] if random.random() < 0.5 else int(random.integers(len(labels)))
        chains.append((i, by_label[other][int(random.integers(len(by_label[other])))]))
    picked = [r for chain in chains for r in chain]
    texts = [runs[r][1] for r in picked]
    words = letters(*text_bytes(pa.array([t.replace("\n", " ") for t in texts])))
    truth = np.repeat([runs[r][0] for r in picked], words.counts)
    counts = words.counts.reshape(-1, 2).sum(axis=1)
    hashes = words.hashes()
    distinct, first, inverse, often = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
    frequent = np.argsort(-often, kind="stable")[:LEXICON]
    lexicon = np.sort(distinct[frequent[often[frequent] >= 5]])
    known, rank = _look_up(lexicon, distinct)
    kinds = _features(words, first)
    owners = [np.repeat(np.arange(len(first)), np.diff(np.append(begins, len(feature)))) for feature, begins in kinds]
    width = FEATURES + len(lexicon)
    weights, moves = np.zeros((width, len(labels))), np.zeros((len(labels), len(labels)))
    gathered_w, gathered_m = np.full_like(weights, 1e-8), np.full_like(moves, 1e-8)
    starts = np.cumsum(counts) - counts
    follows = np.ones(len(truth), bool)
    follows[starts] = False
    pairs = np.bincount(truth[np.flatnonzero(follows) - 1] * len(labels) + truth[follows], minlength=len(labels) ** 2).reshape(moves.shape)
    n = len(truth)
    for _ in range(rounds):
        scores = np.zeros((len(first), len(labels)))
        for feature, begins in kinds:
            scores += np.add.reduceat(weights[feature], begins, axis=0)
        scores[known] += weights[FEATURES + rank[known]]
        potential = np.exp(scores - scores.max(axis=1, keepdims=True))
        per_word, expected = np.zeros((len(first), len(labels))), np.zeros_like(moves)
        for a, b in _pieces(counts, len(labels)):
            some = slice(starts[a], starts[b - 1] + counts[b - 1])
            error, sums = _short_marginals(potential[inverse[some]], np.exp(moves), counts[a:b])
            expected += sums
            error *= -1
            error[np.arange(len(error)), truth[some]] += 1
            order = np.argsort(inverse[some], kind="stable")
            at = np.flatnonzero(np.diff(inverse[some][order], prepend=-1))
            per_word[inverse[some][order[at]]] += np.add.reduceat(error[order], at, axis=0)
        slope = np.zeros_like(weights)
        for (feature, _), owner in zip(kinds, owners):
            for k in range(len(labels)):
                slope[:, k] += np.bincount(feature, weights=per_word[owner, k], minlength=width)
        slope[FEATURES + rank[known]] += per_word[known]
        slope, turn = slope / n - decay * weights, (pairs - expected) / n - decay * moves
        gathered_w += slope ** 2
        gathered_m += turn ** 2
        weights += rate * slope / np.sqrt(gathered_w)
        moves += rate * turn / np.sqrt(gathered_m)
    return Model(labels, weights.astype(np.float32), moves.astype(np.float32), lexicon)


def _pieces(counts: np.ndarray, labels: int) -> Iterator[tuple[int, int]]:
    """Ranges of chains whose words times labels fill about ``CELLS``."""
    ends, a = np.cumsum(counts), 0
    while a < len(counts):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + CELLS // labels, side="right")))
        yield a, b
        a = b


def _short_marginals(potential: np.ndarray, moves: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``marginals`` for many short chains of one word at least, and the expected moves between labels: work grows with the square of the labels."""
    starts, longest = np.cumsum(counts) - counts, int(counts.max())
    order = np.argsort(-counts, kind="stable")
    active = [starts[order[:k]] for k in np.searchsorted(-counts[order], -np.arange(1, longest + 1), side="right")]
    ahead, behind = potential / potential.sum(axis=1, keepdims=True), np.ones_like(potential)
    for k in range(1, longest):
        at = active[k] + k
        value = (ahead[at - 1] @ moves) * potential[at]
        ahead[at] = value / value.sum(axis=1, keepdims=True)
    sums = np.zeros_like(moves)
    for k in range(longest - 1, 0, -1):
        at = active[k] + k
        right = potential[at] * behind[at]
        left = right @ moves.T
        sums += ahead[at - 1].T @ (right / (ahead[at - 1] * left).sum(axis=1, keepdims=True))
        behind[at - 1] = left / left.sum(axis=1, keepdims=True)
    posterior = ahead * behind
    return posterior / posterior.sum(axis=1, keepdims=True), sums * moves


def _pair_sums(potential: np.ndarray, moves: np.ndarray, posterior: np.ndarray, follows: np.ndarray) -> np.ndarray:
    """Expected moves between labels, from neighbours' posteriors.

    p(y, y') is proportional to a(y) moves(y, y') b(y') with a and b fitted to both marginals, which fixes
    them; a few rescalings reach that.
    """
    after = np.flatnonzero(follows)
    left, right = posterior[after - 1], posterior[after]
    joint = left[:, :, None] * moves[None] * right[:, None, :]
    for _ in range(8):
        joint *= (left / np.maximum(joint.sum(axis=2), 1e-300))[:, :, None]
        joint *= (right / np.maximum(joint.sum(axis=1), 1e-300))[:, None, :]
    return joint.sum(axis=0)


def train(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """A model from the rows of ``df`` with text and language."""
    usable = df.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    return fit(sample_runs(usable.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))))


# --- scoring ---


def identify(df: DataFrame, model: Model, text: str = "text", into: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """The frame with ``lang_pred`` and ``score`` of every whole text, or with these under the names ``into``.

    Every word gets a posterior over the languages; ``lang_pred`` has the greatest expected share of words, ``score`` is
    that share; equal shares go to the first label in order.  Null texts, texts without a letter, and all texts if nothing was learned, are ``und`` with
    score 0.  Repeated rows get equal answers; no rows give no rows.  Columns of those two names are
    replaced, others are carried along.
    """
    df = df.drop(*into)
    names = np.array([*model.labels, UNKNOWN], dtype=object)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in _bounded(batch, text, len(model.labels)):
                column = piece.column(text)
                best, score = np.full(len(column), len(names) - 1), np.zeros(len(column))
                if model.labels:
                    shares, counts = model.shares(*text_bytes(column))
                    some = np.flatnonzero(counts)
                    top = shares.argmax(axis=1)
                    best[some], score[some] = top[some], np.minimum(shares[some, top[some]], 1.0)
                    plain = _latin(column)
                    for i in some[~plain[some]]:
                        if not any(c.isalpha() for c in column[i].as_py()):
                            best[i], score[i] = len(names) - 1, 0.0
                yield pa.RecordBatch.from_arrays(
                    [*piece.columns, pa.array(names[best], pa.string()), pa.array(score)], [*piece.schema.names, *into])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + f", `{into[0]}` string, `{into[1]}` double"
    return df.mapInArrow(work, schema)


def _bounded(batch: pa.RecordBatch, text: str, labels: int) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch: a segment of a text takes a matrix of the labels' square, a text one segment at least."""
    square = max(1, labels) ** 2
    for piece in slices(batch, text, min(4 << 20, max(1 << 12, CELLS * 128 // square))):
        rows = max(1, CELLS // square)
        for a in range(0, piece.num_rows, rows):
            yield piece.slice(a, rows)


def _latin(column: pa.Array) -> np.ndarray:
    """Texts with an ASCII letter; the rest is asked letter by letter."""
    return np.asarray(pc.match_substring_regex(column, "[A-Za-z]").fill_null(False))


def held_out(key: str, parts: int, rest: int):
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % parts == rest


def keep_identified(df: DataFrame, model: Model, least: float = 0.35, text: str = "text") -> DataFrame:
    """The rows whose language is known and has a share of at least ``least``; columns stay as they are."""
    label, share = free_name(df, "__label"), free_name(df, "__share")
    found = identify(df, model, text, (label, share))
    return found.where((F.col(label) != UNKNOWN) & (F.col(share) >= least)).drop(label, share)
