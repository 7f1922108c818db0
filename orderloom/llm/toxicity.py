"""Toxicity: a support vector machine on a subsequence string kernel, with Nystroem landmarks.

A sentence is a set of short character windows. Two windows are compared by the
gap-weighted subsequence kernel: all common subsequences of ``ORDER`` characters
count, each gap inside them costs a factor, so "i-d-i.o.t" or "idxiot" stay near
"idiot". Single characters in a row are read as one word, and words too short for such a subsequence stand between
marks of their ends, which count as characters. The landmarks are
character strings that mark the toxic class in labelled sentences: as many as it takes until each toxic
document of the sample that holds a telling string holds a landmark. A sentence's
features are its windows' kernel values against the landmarks, whitened by the
landmarks' own kernel matrix; the machine is linear in them. As only documents
are labelled, each toxic document is learnt by its most toxic sentence, chosen
anew in every round. A document's score is that of its worst sentence.
"""

from __future__ import annotations

import heapq
import itertools
import math
import re
import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.tables import label_sample, labelled_rows, whole_text
from orderloom.sources.staging import stage

ORDER, DECAY, POWER = 4, 0.6, 3
WINDOW, STRIDE = 12, 6
GRAMS = (4, 5, 6, 7, 8)
START, END = "\x02", "\x03"  # of words shorter than ORDER
LANDMARKS = 1024  # at most; the labelled sample needs as many as it has different insults
CANDIDATES = 16384  # telling strings among which landmarks are chosen
LEAST_TOXIC = 3  # documents of the sample that a landmark must be in
UNMARKED = 0.1  # the most that a sentence without a likeness to any landmark can score
MAX_LABELLED = 3000  # of either class
SENTENCE_WORDS = 40
BEST_SENTENCES = 3  # per labelled document
PAIRS_AT_ONCE = 1 << 14
SLICE_BYTES = 1 << 22  # of text read at once
KNOWN_WORDS = 1 << 18  # whose values a task remembers


def kernel(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Subsequence kernel of each row of ``a`` with the same row of ``b``: code points, padded by 0."""
    width = b.shape[1]
    fall = DECAY ** np.subtract.outer(np.arange(width), np.arange(width)).T.astype(np.float32)
    fall = np.triu(fall).astype(np.float32)
    # state[i][:, j]: common subsequences of i characters in the prefixes read so far, weighted up to their ends
    state = [np.ones((len(a), width), np.float32)] + [np.zeros((len(a), width), np.float32) for _ in range(ORDER - 1)]
    total = np.zeros(len(a), np.float32)
    for at in range(a.shape[1]):
        same = ((b == a[:, at : at + 1]) & (b != 0)).astype(np.float32) * np.float32(DECAY * DECAY)
        if not same.any():
            for i in range(1, ORDER):
                state[i] *= np.float32(DECAY)
            continue
        before = [s.copy() for s in state]
        for i in range(1, ORDER):
            shorter = before[i - 1] if i == 1 else np.concatenate([np.zeros((len(a), 1), np.float32), before[i - 1][:, :-1]], 1)
            state[i] = before[i] * np.float32(DECAY) + (same * shorter) @ fall
        total += (same[:, 1:] * before[ORDER - 1][:, :-1]).sum(1)
    return total


def _rows(words: list[str], width: int) -> np.ndarray:
    return np.array(words, dtype=f"U{width}").view(np.uint32).reshape(len(words), width).astype(np.int32)


def _letters(rows: np.ndarray) -> np.ndarray:
    """A bit for each character that occurs; characters may share a bit."""
    bits = np.where(rows > 0, np.uint64(1) << (rows % 61).astype(np.uint64), np.uint64(0))
    return np.bitwise_or.reduce(bits, axis=1) if rows.shape[1] else np.zeros(len(rows), np.uint64)


@dataclass(frozen=True)
class Landmarks:
    words: tuple[str, ...]

    def similarities(self, windows: list[str]) -> np.ndarray:
        """Powers of the normalised kernel, windows x landmarks."""
        out = np.zeros((len(windows), len(self.words)), np.float32)
        if not windows or not self.words:
            return out
        rows, marks = _rows(windows, WINDOW), _rows(list(self.words), max(GRAMS))
        have, want = _letters(rows), _letters(marks)
        own = np.sqrt(kernel(marks, marks))
        # A common subsequence of ORDER characters has about that many different letters; repeats in the landmark may save some.
        need = np.array([max(2, ORDER - (len(w) - len(set(w)))) for w in self.words])
        i, j = np.nonzero(np.bitwise_count(have[:, None] & want[None, :]) >= need[None, :])
        for at in range(0, len(i), PAIRS_AT_ONCE):
            p, q = i[at : at + PAIRS_AT_ONCE], j[at : at + PAIRS_AT_ONCE]
            out[p, q] = kernel(rows[p], marks[q]) / own[q]
        some = np.flatnonzero(out.any(1))
        for at in range(0, len(some), PAIRS_AT_ONCE):
            p = some[at : at + PAIRS_AT_ONCE]
            out[p] /= np.sqrt(kernel(rows[p], rows[p]))[:, None]
        return out**POWER


@dataclass(frozen=True)
class Machine:
    """Margin of a sentence: the sum of its windows' weighted similarities, plus ``bias``."""

    landmarks: Landmarks
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -60, 60)))


def bare(word: str) -> str:
    """The word's letters and digits; a short word between marks of its ends."""
    core = re.sub(r"\W", "", word)
    return START + core + END if 1 < len(core) < ORDER else core


def windows_of(word: str) -> list[str]:
    """Windows of a word, and of its letters and digits alone if others stand between them."""
    core = bare(word)
    if core[:1] == START:
        return [core]
    forms = [word]
    if not word.isalnum() and not word.strip(string.punctuation).isalnum():
        forms.append("".join(c for c in core if c.isalnum()))
    return [f[i : i + WINDOW] for f in forms if f for i in range(0, max(len(f) - STRIDE, 1), STRIDE)]


def read_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """Document and sentence of every word, the words' codes, and the distinct words.

    Words are what white space separates, in lower case; a sentence ends with a
    word that ends in a full stop, question or exclamation mark, or after
    ``SENTENCE_WORDS`` words. Three or more single characters in a row also make a
    word of their own.
    """
    lists = pc.utf8_split_whitespace(pc.utf8_trim_whitespace(pc.utf8_lower(texts)))
    coded = lists.flatten().dictionary_encode()
    words, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    counts = np.diff(lists.offsets.to_numpy())
    doc = np.repeat(np.arange(len(counts)), counts)
    ends = np.array([w[-1:] in ".!?" for w in words], bool)[codes] if len(codes) else np.zeros(0, bool)
    first = np.append(True, doc[1:] != doc[:-1]) if len(doc) else np.zeros(0, bool)
    opens = first | np.append(False, ends[:-1]) if len(doc) else first
    start = np.maximum.accumulate(np.where(opens, np.arange(len(doc)), 0)) if len(doc) else doc
    opens = opens | ((np.arange(len(doc)) - start) % SENTENCE_WORDS == 0)
    sentence = np.cumsum(opens) - 1
    letters = [re.sub(r"\W", "", w) if len(w) < 5 else "" for w in words]
    single = np.array([len(b) == 1 for b in letters], bool)[codes] if len(codes) else np.zeros(0, bool)
    edge = np.flatnonzero(np.diff(np.concatenate([[0], single.astype(np.int8), [0]])))
    extra, known = [], {}
    for a, b in zip(edge[::2], edge[1::2]):
        cuts = np.flatnonzero(np.diff(doc[a:b])) + a + 1
        for x, y in zip([a, *cuts], [*cuts, b]):
            if y - x >= 3:
                word = "".join(letters[c] for c in codes[x:y])
                extra.append((doc[x], sentence[x], known.setdefault(word, len(words) + len(known))))
    if extra:
        added = np.array(extra, np.int64)
        doc, sentence, codes = (np.concatenate([old, added[:, k]]) for k, old in enumerate((doc, sentence, codes)))
    # A sentence is a set of words: one that is repeated counts once.
    if len(codes):
        _, kept = np.unique(sentence * (len(words) + len(known)) + codes, return_index=True)
        doc, sentence, codes = doc[kept], sentence[kept], codes[kept]
    return doc, sentence, codes, words + list(known)


def _word_features(words: list[str], landmarks: Landmarks) -> np.ndarray:
    """Per distinct word the sum over its windows."""
    windows = [(i, w) for i, word in enumerate(words) for w in windows_of(word)]
    out = np.zeros((len(words), len(landmarks.words)), np.float32)
    for at in range(0, len(windows), 1 << 16):
        part = windows[at : at + (1 << 16)]
        values = landmarks.similarities([w for _, w in part])
        np.add.at(out, np.array([i for i, _ in part], np.int64), values)
    return out


def grams_of(word: str) -> set[str]:
    """The strings of a word that may become landmarks."""
    core = bare(word)
    return {core[i : i + n] for n in GRAMS for i in range(len(core) - n + 1)}


def _slices(texts: pa.Array, most_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows with about ``most_bytes`` of text; a longer text is a run of its own."""
    run = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)) // most_bytes
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), len(texts)]
    yield from ((a, b) for a, b in zip(cuts, cuts[1:]) if b > a)


def _grams_by_document(texts: pa.Array, wanted: frozenset[str] | None = None) -> Iterator[tuple[int, set[str]]]:
    """The character strings of each document's words, all or the wanted ones."""
    doc, _, codes, words = read_words(texts)
    pairs = np.unique(np.stack([doc, codes], 1), axis=0) if len(doc) else np.zeros((0, 2), np.int64)
    grams: dict[int, set[str]] = {}
    for d, own in itertools.groupby(pairs.tolist(), key=lambda p: p[0]):
        found: set[str] = set()
        for _, c in own:
            if c not in grams:
                grams[c] = grams_of(words[c]) if wanted is None else grams_of(words[c]) & wanted
            found |= grams[c]
        yield d, found


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, toxic documents, other documents), added up over a slice of text."""
    for batch in batches:
        labels = batch.column(1).to_pylist()
        for first, last in _slices(batch.column(0)):
            counts: dict[str, list[int]] = {}
            for d, found in _grams_by_document(batch.column(0).slice(first, last - first)):
                place = 0 if labels[first + d] else 1
                for g in found:
                    counts.setdefault(g, [0, 0])[place] += 1
            columns = [pa.array(list(counts), pa.string()), *(pa.array([c[i] for c in counts.values()], pa.int64()) for i in (0, 1))]
            yield pa.RecordBatch.from_arrays(columns, names=["gram", "toxic", "other"])


def _told(wanted: frozenset[str]):
    """(gram, document) of the wanted strings."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(1).to_pylist()
            for first, last in _slices(batch.column(0)):
                rows = [(g, names[first + d]) for d, found in _grams_by_document(batch.column(0).slice(first, last - first), wanted) for g in found]
                gram, name = zip(*rows) if rows else ((), ())
                yield pa.RecordBatch.from_arrays([pa.array(gram, pa.string()), pa.array(name, pa.int64())], names=["gram", "doc"])

    return find


def choose_landmarks(rows: DataFrame, most: int = LANDMARKS) -> Landmarks:
    """Strings that tell toxic documents, chosen one after the other.

    A telling string is in at least ``LEAST_TOXIC`` toxic documents and at odds of e^2 or more. Each time
    the one is taken that tells most documents in which no landmark is yet, until none tells ``LEAST_TOXIC`` more. What
    reaches the driver is bounded by the sample: strings and the sample documents they are in.
    """
    sizes = {r["__label"]: r["count"] for r in rows.groupBy("__label").count().collect()}
    toxic, other = sizes.get(1, 0), sizes.get(0, 0)
    counts = rows.select("__text", "__label").mapInArrow(_count_grams, "gram string, toxic long, other long").groupBy("gram")
    counts = counts.agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1.0)) - F.log((F.col("other") + 0.5) / (other + 1.0))
    strong = counts.filter(F.col("toxic") >= LEAST_TOXIC).withColumn("odds", odds).filter("odds > 2")
    ranked = strong.orderBy((F.col("toxic") * F.col("odds")).desc(), F.length("gram").desc(), "gram").limit(CANDIDATES).collect()
    strength = {r["gram"]: r["odds"] for r in ranked}
    if not strength:
        return Landmarks(())
    told = rows.filter("__label = 1").select("__text", "__doc").mapInArrow(_told(frozenset(strength)), "gram string, doc long")
    documents = {r["gram"]: set(r["docs"]) for r in told.groupBy("gram").agg(F.collect_set("doc").alias("docs")).collect()}

    left, chosen = set().union(*documents.values()), []

    def entry(gram: str) -> tuple[float, int, str]:
        """Least for the string that tells most documents not yet told; of equals, for the longest."""
        return -len(documents[gram] & left) * strength[gram], -len(gram.strip(START + END)), gram

    queue = [entry(g) for g in documents]
    heapq.heapify(queue)
    while queue and len(chosen) < most:
        gram = heapq.heappop(queue)[2]
        if len(documents[gram] & left) < LEAST_TOXIC:
            continue
        if queue and entry(gram) > queue[0]:
            heapq.heappush(queue, entry(gram))  # it tells fewer than when it was queued
            continue
        chosen.append(gram)
        left -= documents[gram]
    return Landmarks(tuple(chosen))


def _sentences(landmarks: Landmarks):
    """(label, document's number, features) of the sentences of each document that are most like landmarks."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column(1).to_pylist()
            doc, sentence, codes, words = read_words(batch.column(0))
            per_word = _word_features(words, landmarks)
            features = np.zeros((int(sentence.max()) + 1 if len(sentence) else 0, per_word.shape[1]), np.float32)
            np.add.at(features, sentence, per_word[codes])
            owner = np.zeros(len(features), np.int64)
            owner[sentence] = doc
            out = []
            order = np.lexsort((-features.sum(1), owner))
            starts = np.searchsorted(owner[order], np.arange(len(labels)))
            for d in range(len(labels)):
                mine = [s for s in order[starts[d] : starts[d] + BEST_SENTENCES] if owner[s] == d]
                out.append((labels[d], [features[s].tolist() for s in mine] or [[0.0] * per_word.shape[1]]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in out], pa.int32()), pa.array([y for _, y in out], pa.list_(pa.list_(pa.float32())))], names=["label", "sentences"]
            )

    return read


def _train(x: np.ndarray, y: np.ndarray, cost: float) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss and balanced classes, by Newton steps on the rows inside the margin."""
    design, weight = np.hstack([x, np.ones((len(x), 1))]), np.zeros(x.shape[1] + 1)
    each = np.where(y > 0, len(y) / (2 * max((y > 0).sum(), 1)), len(y) / (2 * max((y < 0).sum(), 1))) * cost
    ridge = np.eye(len(weight))
    ridge[-1, -1] = 1e-3
    for _ in range(50):
        inside = y * (design @ weight) < 1
        part, w = design[inside], each[inside]
        new = np.linalg.solve(ridge + (part * w[:, None]).T @ part, (part * w[:, None]).T @ y[inside])
        if np.allclose(new, weight, atol=1e-8):
            break
        weight = 0.5 * (weight + new) if _ > 10 else new
    return weight[:-1], float(weight[-1])


def _calibrate(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Logistic curve through the margins of documents, slightly regularised."""
    slope, offset = 1.0, 0.0
    design = np.stack([margin, np.ones(len(margin))], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ [slope, offset], -30, 30)))
        grad = design.T @ (p - label) + 1e-2 * np.array([slope - 1, offset])
        hess = (design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        slope, offset = slope - step[0], offset - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(max(slope, 1e-3)), float(offset)


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", max_rows: int = MAX_LABELLED, cost: float = 1.0
) -> Machine:
    """Learn from at most ``max_rows`` labelled documents of either class among those where ``train`` holds."""
    sample = label_sample(labels.filter("toxic = 1"), "toxic", id_col, train, max_rows).unionByName(
        label_sample(labels.filter("toxic = 0"), "toxic", id_col, train, max_rows)
    )
    rows = labelled_rows(docs.select(id_col, whole_text(text_col).alias("__text")), sample, id_col).select("__text", "__label")
    rows = rows.repartition(max(1, rows.sparkSession.sparkContext.defaultParallelism)).withColumn("__doc", F.monotonically_increasing_id())
    rows = stage(rows, "toxic-sample")
    landmarks = choose_landmarks(rows)
    read = rows.select("__text", "__label").mapInArrow(_sentences(landmarks), "label int, sentences array<array<float>>").collect()
    # Toxic documents that are like no landmark teach nothing about those that are.
    read = [r for r in read if not r["label"] or any(v > 0 for s in r["sentences"] for v in s)]
    y = np.array([r["label"] for r in read])
    if not landmarks.words or len(set(y.tolist())) < 2:
        share = min(max(float(y.mean()) if len(y) else 0.5, 1e-6), 1 - 1e-6)
        return Machine(Landmarks(()), np.zeros(0), 0.0, 1.0, math.log(share / (1 - share)))
    base = np.linalg.eigh(landmarks.similarities(list(landmarks.words)).astype(float))
    whiten = base[1] @ np.diag(1 / np.sqrt(np.maximum(base[0], 1e-3))) @ base[1].T
    bags = [np.array(r["sentences"], float) @ whiten for r in read]
    witness = [0] * len(bags)
    for _ in range(5):
        x = np.concatenate([b[[w]] if t else b for b, w, t in zip(bags, witness, y)])
        sign = np.concatenate([[1.0] if t else -np.ones(len(b)) for b, t in zip(bags, y)])
        weights, bias = _train(x, sign, cost)
        now = [int(np.argmax(b @ weights)) for b in bags]
        if now == witness:
            break
        witness = now
    margin = np.array([(b @ weights).max() for b in bags]) + bias
    # Sample classes are not in the labels' proportion; the curve is fitted to what the sample holds, and
    # moved down where it would give more than UNMARKED to a sentence that is like no landmark.
    slope, offset = _calibrate(margin, y)
    return Machine(landmarks, whiten @ weights, bias, slope, min(offset, math.log(UNMARKED / (1 - UNMARKED)) - slope * bias))


def _score(machine: Machine):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}  # words' values, some of the latest

        def values(words: list[str]) -> np.ndarray:
            new = [w for w in words if w not in known]
            if len(known) + len(new) > KNOWN_WORDS:
                known.clear()
                new = words
            for at in range(0, len(new), 1 << 13):
                part = new[at : at + (1 << 13)]
                known.update(zip(part, (_word_features(part, machine.landmarks) @ machine.weights).tolist()))
            return np.array([known[w] for w in words])

        for batch in batches:
            if not batch.num_rows:
                continue
            texts = batch.column(batch.num_columns - 1)
            margin = np.full(batch.num_rows, machine.bias)
            for first, last in _slices(texts) if machine.landmarks.words else ():
                doc, sentence, codes, words = read_words(texts.slice(first, last - first))
                sums = np.bincount(sentence, values(words)[codes], minlength=0) if len(codes) else np.zeros(0)
                owner = np.zeros(len(sums), np.int64)
                owner[sentence] = doc
                best = np.full(last - first, -np.inf)
                np.maximum.at(best, owner, sums)
                margin[first:last] += np.where(np.isfinite(best), best, 0.0)
            names = batch.schema.names[:-1]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(machine.probability(margin))], names=[*names, "toxic_score"])

    return score


def toxicity_scores(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """One row per row of ``docs``: id, ``toxic_score``, ``toxic_predicted``.

    Null and empty texts get the score of a text without windows; texts of any
    length are read whole; repeated rows get equal scores; a null id stays null;
    other columns are ignored; an empty table gives no rows. Without labels of
    both classes the score is constant.
    """
    rows = docs.select(id_col, whole_text(text_col).alias("__text"))
    kind = docs.schema[id_col].dataType.simpleString()
    scored = rows.mapInArrow(_score(machine), f"`{id_col}` {kind}, toxic_score double")
    return scored.withColumn("toxic_predicted", (F.col("toxic_score") >= threshold).cast("int"))
