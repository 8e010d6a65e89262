"""Toxicity by a subsequence string-kernel SVM with Nystroem landmarks.

The kernel counts common subsequences of four characters, the start of a word being one, each weighted down
by the length of the stretch it covers in either word, and is normalised: an
insult keeps most of its kernel with itself when characters are inserted,
left out or hung on at its ends. White space is a gap too: runs of short
words (at most `Settings.short` letters and digits) are joined to words of up to `width` characters,
from each of their words to each other, and these are compared like words. Landmarks are words of the training sample, or their beginnings; a
sentence is described by its words' largest kernel with each landmark and by
their mean over its words, both mapped by the inverse square root of the
landmarks' kernel matrix (Nystroem), and a
linear SVM on that map is trained on labelled sentences. A label belongs to a
document, so training repeatedly picks the sentences of a toxic document that
speak for it (multiple-instance SVM). A document's margin is its largest
sentence margin; a logistic fit on the training documents turns it into a
score, and a second one, with the first as its offset, adds what the whole
document says: the largest kernel, the sum of kernels and their mean over all
words, for each landmark. So a word that also occurs by chance counts by how often it
recurs. (This second fit is on the kernels themselves: through the Nystroem map
it did worse in cross-validation on the fitting sample.)

Fitted on a bounded sample (`Settings.docs_per_class` labelled documents of
each class, whole texts until `Settings.chars` code points of a class are
passed); scoring reads whole texts. Landmarks are taken until every word of
the sample that tells the classes apart has one; near copies (texts with the
same smallest shingle hash) count once there, so the plain words of a toxic
document that was often copied are no landmarks; they are only looked at if
it holds no other.
Labels, language, source and ids are never inputs of a score.

Defined results: NULL and empty texts get the score of a sentence without any
landmark-like word; documents without a label are scored like all others; a
label that is NULL or belongs to no document is not used; without labels of
both classes every score is 0; a repeated row gives the same score again; an
empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import repeat
from uuid import uuid4

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from threadmill.llm.common import stage, table, worker_state

SENTENCE_ENDS = ".!?\n"
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: Words, and runs of short words, that a worker remembers.
WORDS, RUNS = 600_000, 300_000
#: Tasks that work out the evidence of the fitting sample.
SAMPLE_TASKS = 32
#: Tasks that add up the evidence in a Newton step: each hands its sums, some MB, to the driver.
SUM_TASKS = 6
#: Characters of texts, or bytes of evidence, that are worked on at a time (a longer text alone).
SAMPLE_BLOCK, SCORE_BLOCK, EVIDENCE_BLOCK = 200_000, 1_000_000, 8_000_000
START = "\x02"  # stands before each word, so that its beginning takes part in the kernel


@dataclass(frozen=True)
class Settings:
    """Bounds of the fitting sample and parameters of the kernel."""

    docs_per_class: int = 2000
    chars: int = 20_000_000  # of a class
    fallback: int = 32  # words to take landmarks from where no word tells the classes apart
    stems: tuple[int, ...] = (4, 5, 6)  # lengths of word beginnings that may be landmarks
    order: int = 4
    decay: float = 0.9
    least_z: float = 4.0  # a candidate's rates in the two classes differ by so many standard errors,
    lift: float = 3.0  # and by this factor
    least_kernel: float = 0.3  # smaller kernels with a landmark count as none
    common: float = 0.7  # share of a landmark's characters that a word must have for its kernel to be worked out
    apart: float = 0.6  # a landmark's largest kernel with those before it
    short: int = 3  # words that may be parts of a word with blanks in it
    joined_kernel: float = 0.6  # least kernel of such a word: it is looked at from each of its parts to each other
    width: int = 20  # longer words are looked at in overlapping windows of this width
    svm_c: float = 2.0
    rounds: int = 4
    steps: int = 8  # of a round at most
    least_count: int = 3  # toxic documents of the sample that a candidate occurs in
    ridge: float = 0.004  # of the document's own weights, for each document of the sample; by cross-validation on a sample


# ------------------------------------------------------------------ the kernel


def _codes(words: list[str], width: int) -> np.ndarray:
    """Words as rows of code points, padded with 0."""
    return np.array(words, dtype=f"<U{width}").view("<u4").reshape(len(words), width).astype(np.int32)


WORD_ROWS, PAIR_ROWS = 4000, 8000  # words, and pairs of them with landmarks, that are looked at together
KERNEL_ROWS = 4096  # pairs whose partial sums are worked on at a time: they stay in the processor's cache


def subsequence_kernel(a: np.ndarray, b: np.ndarray, order: int, decay: float) -> np.ndarray:
    """Gap-weighted subsequence kernel of each row of `a` with the same row of `b`
    (code points, 0 pads at the right)."""
    total = np.zeros(len(b), np.float32)
    for at in range(0, len(b), KERNEL_ROWS):
        _kernel_block(a[at : at + KERNEL_ROWS].T, b[at : at + KERNEL_ROWS].T, order, np.float32(decay), total[at : at + KERNEL_ROWS])
    return total


def _kernel_block(a: np.ndarray, b: np.ndarray, order: int, decay: np.float32, total: np.ndarray) -> None:
    """Adds the kernels to `total`; a column is a pair here, so every step runs along memory."""
    a, b = np.ascontiguousarray(a), np.ascontiguousarray(b)
    width, pairs = b.shape
    real = b != 0
    ones = np.ones((width + 1, pairs), np.float32)
    partial = [ones] + [np.zeros((width + 1, pairs), np.float32) for _ in range(order - 1)]  # by subsequence length, over prefixes of b
    ends, square = np.empty((width, pairs), np.float32), decay * decay
    for c in a:
        if not c.any():
            break
        same = (b == c) & real
        if not same.any():
            for p in partial[1:]:
                p *= decay
            continue
        same = same.astype(np.float32)
        total += (same * partial[order - 1][:-1]).sum(axis=0)
        for k in range(order - 1, 0, -1):
            np.multiply(same, partial[k - 1][:-1], out=ends)
            for j in range(1, width):  # a match at j goes on to stand at every later place
                ends[j] += decay * ends[j - 1]
            partial[k] *= decay
            partial[k][1:] += square * ends
    total *= square


def _chains(counts, order: int, decay: float):
    """Sum over the increasing choices of `order` of the given numbers (or arrays), of the chosen
    ones' product times the decay to the length of the stretch they cover."""
    total, sums = 0.0, [0.0] * (order - 1)  # sums[k]: over choices of k + 1, decayed up to here
    for r in counts:
        ends = [r, *(r * q for q in sums)]
        total = total + decay * ends[-1]
        sums = [decay * (q + e) for q, e in zip(sums, ends)]
    return total


class Kernel:
    """Normalised kernels of words with a fixed list of landmarks."""

    def __init__(self, landmarks: list[str], settings: Settings):
        self.s, self.landmarks = settings, landmarks
        cut = [(START + w)[: settings.width] for w in landmarks]
        self.codes = _codes(cut, max(map(len, cut)))
        self.own = self._self(self.codes)
        self.masks = self._masks(self.codes)
        self.letters = np.unique(self.codes[self.codes > 0])
        self.place = np.where(self.codes > 0, np.searchsorted(self.letters, self.codes), len(self.letters))
        self.times = np.zeros((len(landmarks), len(self.letters) + 1), np.float32)  # of each letter in each landmark
        np.add.at(self.times, (np.arange(len(landmarks))[:, None], self.place), 1)
        self.times[:, -1] = 0
        # a word's kernel with itself is at least what it has without repeated letters
        self.least_own = np.sqrt([max(1e-12, _chains([1.0] * n, settings.order, settings.decay**2)) for n in range(settings.width + 1)]).astype(np.float32)

    def _self(self, codes: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(subsequence_kernel(codes, codes, self.s.order, self.s.decay), 1e-12))

    @staticmethod
    def _masks(codes: np.ndarray) -> np.ndarray:
        bits = np.where(codes > 0, np.left_shift(np.uint64(1), (codes % 61).astype(np.uint64)), np.uint64(0))
        return np.bitwise_or.reduce(bits, axis=1)

    def _in_order(self, codes: np.ndarray, mark: np.ndarray) -> np.ndarray:
        """Whether a landmark and a word share a subsequence of `order` characters: else their kernel is 0.
        Bit-parallel: a zero bit for each character of a longest common subsequence."""
        width = codes.shape[1]
        bit = (2.0 ** np.arange(width)).astype(np.float32)  # sums are exact below 2 ** 24
        full = np.int64((1 << width) - 1)
        v = np.full(len(codes), full, np.int64)
        for i in range(self.codes.shape[1]):
            c = self.codes[mark, i]
            u = v & ((codes == c[:, None]) & (c != 0)[:, None]).astype(np.float32).dot(bit).astype(np.int64)
            v = ((v + u) | (v - u)) & full
        return width - np.bitwise_count(v) >= self.s.order

    def _most(self, codes: np.ndarray, row: np.ndarray, mark: np.ndarray, least: float) -> np.ndarray:
        """Upper bounds of the kernels of words and landmarks, exact enough where they reach `least`.

        The letters of the one may match those of the other in any order: the sum over such matches
        is taken along the landmark, without gaps in the word, and where that reaches `least` also along
        the word (Cauchy-Schwarz over the matches). Over the least that a word can have with itself.
        """
        place = np.searchsorted(self.letters, codes)
        place[self.letters[np.minimum(place, len(self.letters) - 1)] != codes] = len(self.letters)
        counts = np.zeros((len(self.letters) + 1, len(codes)), np.float32)
        for i in range(len(self.letters)):
            counts[i] = (place == i).sum(axis=1)
        order, decay = self.s.order, np.float32(self.s.decay)
        own = self.least_own[np.count_nonzero(codes, axis=1)][row] * self.own[mark]
        most = decay**order * _chains((counts[p[mark], row] for p in self.place.T), order, decay) / own
        on = np.flatnonzero(most >= 0.999 * least)
        row, mark = row[on], mark[on]
        along = _chains((counts[p[mark], row] for p in self.place.T), order, decay**2)
        across = _chains((self.times[mark, p[row]] for p in np.ascontiguousarray(place.T)), order, decay**2)
        most[on] = np.sqrt(along * across) / own[on]
        return most

    def features(self, words: list[str], some_reach: float = 0.0) -> list[np.ndarray | None]:
        """For each word its kernels with the landmarks, None where all are small
        (or where no landmark's can reach `some_reach`)."""
        w, step = self.s.width, self.s.width // 2
        parts, owner = [START + x for x in words], list(range(len(words)))
        for i in [i for i, word in enumerate(parts) if len(word) > w]:
            word = parts[i]
            windows = [word[j : j + w] for j in range(0, len(word) - w + step, step)]
            parts[i] = windows[0]
            parts += windows[1:]
            owner += [i] * (len(windows) - 1)
        ranked = np.argsort(np.fromiter(map(len, parts), np.int64, len(parts)), kind="stable").tolist()  # a block is as wide as its longest word
        least = np.maximum(2, np.ceil(np.bitwise_count(self.masks) * self.s.common))[None, :]
        out: list[np.ndarray | None] = [None] * len(words)
        for at in range(0, len(parts), WORD_ROWS):
            some = ranked[at : at + WORD_ROWS]
            codes = _codes([parts[i] for i in some], max(1, len(parts[some[-1]])))
            # a kernel can only be large if most of the landmark's characters occur
            common = np.bitwise_count(self._masks(codes)[:, None] & self.masks[None, :])
            row, mark = np.nonzero(common >= least)
            most = self._most(codes, row, mark, self.s.least_kernel) if len(row) else np.zeros(0)
            near = np.zeros(len(some), bool)
            near[row[most >= 0.999 * some_reach]] = True  # room for rounding
            within = (most >= 0.999 * self.s.least_kernel) & near[row]
            row, mark = row[within], mark[within]
            kept = [self._in_order(codes[row[k : k + PAIR_ROWS]], mark[k : k + PAIR_ROWS]) for k in range(0, len(row), PAIR_ROWS)]
            if kept:
                kept = np.concatenate(kept)
                row, mark = row[kept], mark[kept]
            if not len(row):
                continue
            near = np.unique(row)
            own = np.zeros(len(some), np.float32)
            own[near] = self._self(codes[near])
            for k in range(0, len(row), PAIR_ROWS):
                r, m = row[k : k + PAIR_ROWS], mark[k : k + PAIR_ROWS]
                value = subsequence_kernel(codes[r], self.codes[m], self.s.order, self.s.decay) / (own[r] * self.own[m])
                hit = value >= self.s.least_kernel
                for x, y, v in zip(r[hit], m[hit], value[hit]):
                    i = owner[some[x]]
                    if out[i] is None:
                        out[i] = np.zeros(len(self.landmarks), np.float32)
                    out[i][y] = max(out[i][y], v)
        return out


def words_of(text: str) -> list[str]:
    """Lower-cased words between white space, sentence ends kept on them."""
    return text.lower().split()


def core(word: str) -> str:
    """A word without the characters that are no letters or digits at its ends."""
    word = word.strip(PUNCTUATION)
    if word.isalnum():
        return word
    a, b = 0, len(word)
    while a < b and not word[a].isalnum():
        a += 1
    while b > a and not word[b - 1].isalnum():
        b -= 1
    return word[a:b]


class Scorer:
    """A fitted model in a worker: documents to margins."""

    def __init__(self, model: dict):
        self.model = model
        self.kernel = Kernel(model["landmarks"], model["settings"])
        self.words: dict[str, int] = {}  # the place in `notes` of each word met
        self.notes: list[tuple[str | None, np.ndarray | None]] = [(None, None)]  # cores of short words, and kernels; of most words neither
        self.runs: dict[tuple[str, ...], list[tuple[int, int, np.ndarray]]] = {}
        sizes = [len(w) for w in model["landmarks"]]
        self.joined = max(3, min(sizes) - 1), min(self.kernel.s.width - 1, max(sizes) + 2)  # lengths of joined words

    def learn(self, texts: list[list[str]]) -> list[tuple[list, list[tuple[int, tuple[str, ...]]]]]:
        """Put the kernels of all words that are new into the cache; gives the texts'
        landmark-like words (place, 0, kernels) and their runs of short words."""
        if len(self.words) > WORDS:
            self.words.clear()
            del self.notes[1:]
        places = [np.fromiter(map(self.words.get, words, repeat(-1)), np.int64, len(words)) for words in texts]
        unknown = [np.flatnonzero(at < 0).tolist() for at in places]
        new = list({words[i] for words, at in zip(texts, unknown) for i in at})
        cores = [core(w) for w in new]
        distinct = list(dict.fromkeys(cores))
        found, short = dict(zip(distinct, self.kernel.features(distinct))), self.kernel.s.short
        for w, c in zip(new, cores):
            value = found[c]
            if value is None and len(c) > short:
                self.words[w] = 0
            else:
                self.words[w] = len(self.notes)
                self.notes.append((c if len(c) <= short else None, value))
        if len(self.runs) > RUNS:
            self.runs.clear()
        for words, at, some in zip(texts, places, unknown):
            at[some] = [self.words[words[i]] for i in some]
        noted = list(map(self.noted, places))
        self.learn_runs({run for _, runs in noted for _, run in runs}.difference(self.runs))
        return noted

    def noted(self, places: np.ndarray) -> tuple[list, list[tuple[int, tuple[str, ...]]]]:
        """A text's landmark-like words, and where its runs of two or more short words
        begin and their cores; sentence ends don't end them."""
        at = np.flatnonzero(places)
        hits, runs, run = [], [], []
        for i, k in zip(at.tolist(), places[at].tolist()):
            part, value = self.notes[k]
            if value is not None:
                hits.append((i, 0, value))
            if part is not None:
                if run and i > first + len(run):
                    if len(run) > 1:
                        runs.append((first, tuple(run)))
                    run = []
                if not run:
                    first = i
                run.append(part)
        if len(run) > 1:
            runs.append((first, tuple(run)))
        return hits, runs

    def learn_runs(self, runs: set[tuple[str, ...]]) -> None:
        """Landmark-like words that the words of a run make when joined: where they begin, how many words more they hold, and their kernels."""
        least, most = self.joined
        places = {}
        for run in runs:
            places[run] = found = []
            for i in range(len(run)):
                word = run[i]
                for j in range(i + 1, len(run)) if word else ():
                    word += run[j]
                    if len(word) > most:
                        break
                    if len(word) >= least and run[j]:
                        found.append((i, j, word))
        distinct = list({word for found in places.values() for _, _, word in found})
        least = self.kernel.s.joined_kernel
        value = {w: v if v is not None and v.max() >= least else None for w, v in zip(distinct, self.kernel.features(distinct, some_reach=least))}
        for run, found in places.items():
            hits = sorted(((i, j, value[word]) for i, j, word in found if value[word] is not None), key=lambda h: (-round(float(h[2].max()), 3), h[0] - h[1], h[0]))
            kept, taken = [], set()
            for i, j, v in hits:  # the most alike first, of those the longest; no word takes part in two
                if taken.isdisjoint(range(i, j + 1)):
                    taken.update(range(i, j + 1))
                    kept.append((i, j - i, v))
            self.runs[run] = kept

    def evidence(self, words: list[str], noted: tuple[list, list[tuple[int, tuple[str, ...]]]]) -> tuple[np.ndarray, np.ndarray]:
        """Largest and mean kernel with each landmark, for each sentence with a
        landmark-like word; for the document the largest, the sum and the mean."""
        n = len(self.kernel.landmarks)
        found, runs = noted
        joined = [(at + i, more, v) for at, run in runs for i, more, v in self.runs[run]]
        if joined:
            found = sorted(found + joined, key=lambda h: h[0])
        hits = [i for i, _, _ in found]
        if not hits:
            return np.zeros((0, 2 * n), np.float32), np.zeros(3 * n)
        stops = [i for i, w in enumerate(words) if w[-1] in SENTENCE_ENDS]
        values = np.array([v for _, _, v in found])
        sentence = np.searchsorted(stops, hits)
        edges = np.concatenate([[-1], stops, [len(words) - 1]]).astype(np.int64)
        first = np.flatnonzero(np.diff(sentence, prepend=-1))
        more = np.array([m for _, m, _ in found])  # joined words count once
        length = np.maximum(1, edges[sentence[first] + 1] - edges[sentence[first]] - np.add.reduceat(more, first))
        rows = np.hstack([np.maximum.reduceat(values, first), np.add.reduceat(values, first) / length[:, None]])
        total = values.sum(axis=0, dtype=np.float64)
        # logarithms: the second hit says more than the twentieth
        return rows.astype(np.float32), np.concatenate([values.max(axis=0), np.log1p(total), np.log1p(total / (len(words) - more.sum()) * 100)])

    def margin(self, rows: np.ndarray) -> float:
        """Largest sentence margin."""
        w, b = self.model["weights"], float(self.model["bias"])
        return max(b, float((rows @ w).max() + b)) if len(rows) else b

    def scores(self, texts: list[str]) -> list[float]:
        words = [words_of(t) for t in texts]
        noted = self.learn(words)
        a, c, u = self.model["slope"], self.model["shift"], self.model["whole"]
        found = map(self.evidence, words, noted)
        return [float(1 / (1 + np.exp(-np.clip(a * self.margin(rows) + c + whole @ u, -500, 500)))) for rows, whole in found]


# ------------------------------------------------------------------ fitting


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3, offset: np.ndarray | float = 0.0) -> np.ndarray:
    """Weights of the columns and, last, shift of a logistic fit of the labels (damped Newton)."""
    z = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.append(np.full(x.shape[1], ridge), 1e-3)

    def loss(v):
        t = z @ v + offset
        return (weight * (np.logaddexp(0, t) - y * t)).sum() + (penalty * v * v).sum() / 2

    v, at = np.zeros(z.shape[1]), loss(np.zeros(z.shape[1]))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ v + offset, -30, 30)))
        h = z.T @ (z * (weight * p * (1 - p))[:, None]) + np.diag(penalty)
        step = np.linalg.solve(h, z.T @ (weight * (p - y)) + penalty * v)
        while (new := loss(v - step)) > at and np.abs(step).max() > 1e-9:
            step = step / 2
        if new >= at:
            break
        v, at = v - step, new
    return v


def pieces_of(words: list[str], settings: Settings) -> set[str]:
    """What a text of these words offers as landmarks: its words and their beginnings."""
    own = {core(w) for w in words}
    return {w for w in own | {w[:k] for w in own for k in settings.stems if len(w) > k} if len(w) >= settings.order}


def sketch(words: list[str]) -> int:
    """The smallest hash of a text's 5-word shingles: near copies mostly share it, other texts hardly ever."""
    return min(xxh64_intdigest(" ".join(words[i : i + 5]).encode("utf-8", "replace")) for i in range(max(1, len(words) - 4))) >> 1


def _offers(text: str, settings: Settings) -> tuple[int, set[str]]:
    words = words_of(text)
    return sketch(words), pieces_of(words, settings)


def z_score(toxic, clean, n_toxic: int, n_clean: int):
    """How far the rates of a piece in the two classes lie apart, in standard errors (numbers or columns)."""
    mean = (toxic + clean) / (n_toxic + n_clean)
    return (toxic / n_toxic - clean / n_clean) / (mean * (1 - mean) * (1 / n_clean + 1 / n_toxic) + 1e-12) ** 0.5


def choose_landmarks(ranked: list[str], settings: Settings) -> list[str]:
    """Candidates in order, leaving out what an earlier landmark already covers."""
    left, landmarks = ranked or ["---"], []
    while left:
        landmarks.append(left[0])
        near = Kernel(left[:1], settings).features(left[1:])
        left = [w for w, k in zip(left[1:], near) if k is None or k[0] < settings.apart]
    return landmarks


def _nystroem(landmarks: list[str], settings: Settings) -> np.ndarray:
    """Inverse square root of the landmarks' kernel matrix."""
    kernel = Kernel(landmarks, settings)
    gram = np.array([f if f is not None else np.zeros(len(landmarks)) for f in kernel.features(landmarks)], np.float64)
    values, vectors = np.linalg.eigh((gram + gram.T) / 2 + 1e-3 * np.eye(len(landmarks)))
    return vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-3))) @ vectors.T


def untrained(landmarks: list[str], settings: Settings) -> dict:
    n = len(landmarks)
    return {"landmarks": landmarks, "settings": settings, "weights": np.zeros(2 * n), "bias": 0.0, "slope": 1.0, "shift": 0.0, "whole": np.zeros(3 * n)}


@dataclass
class Bags:
    """Evidence of some documents: all their sentences' rows, and a row of zeros in
    each document for its sentences without landmark-like words."""

    toxic: np.ndarray  # of each document
    rows: np.ndarray
    doc: np.ndarray  # of each row
    whole: np.ndarray

    @staticmethod
    def of(toxic: list[int], rows: list[np.ndarray], whole: list[np.ndarray], size: int) -> Bags:
        zero = np.zeros((1, 2 * size), np.float32)
        doc = np.repeat(np.arange(len(rows)), [len(r) + 1 for r in rows])
        return Bags(np.array(toxic), np.vstack([x for r in rows for x in (zero, r)]) if rows else zero[:0], doc, np.array(whole).reshape(len(rows), 3 * size))


def _targets(bags: Bags, before: tuple[np.ndarray, float] | None) -> np.ndarray:
    """+1 for the rows that speak for their toxic document: at first all of them, then,
    by the weights of the round before, its strongest sentence and those on the toxic side."""
    toxic = bags.toxic[bags.doc] == 1
    if before is None:
        return toxic
    margin = bags.rows @ before[0].astype(np.float32) + np.float32(before[1])
    best = np.full(len(bags.toxic), -np.inf, np.float32)
    np.maximum.at(best, bags.doc, margin)
    return toxic & ((margin > 0) | (margin == best[bags.doc])) & bags.rows.any(axis=1)


def svm_sums(bags: Bags, before: tuple[np.ndarray, float] | None, weights: np.ndarray, bias: float) -> np.ndarray:
    """For the toxic and the other rows, packed: how many there are, their squared hinge
    losses, and over those within the margin the sums of z and of z z' (z: a row and 1; upper triangle)."""
    positive = _targets(bags, before)
    margin = bags.rows @ weights.astype(np.float32) + np.float32(bias)
    out = []
    for side, sign in ((positive, 1.0), (~positive, -1.0)):
        slack = 1 - sign * margin[side].astype(np.float64)
        z = bags.rows[side][slack > 0]
        z = np.hstack([z, np.ones((len(z), 1), np.float32)])
        out += [[side.sum()], [(np.maximum(slack, 0) ** 2).sum()], z.sum(axis=0, dtype=np.float64), (z.T @ z).astype(np.float64)[np.triu_indices(z.shape[1])]]
    return np.concatenate(out)


def train(landmarks: list[str], settings: Settings, sums, gather, clean_per_toxic: float | None = None) -> dict:
    """The model over evidence that lies elsewhere: `sums(before, weights, bias)` adds up
    `svm_sums` of all of it, `gather(weights, bias)` gives each document's label,
    margin and whole-document evidence.

    Each round is a multiple-instance step: a linear SVM (squared hinge) on the
    rows that speak for their documents, solved by Newton steps on its active
    set, a step being one pass over the evidence.
    """
    n = len(landmarks)
    root = _nystroem(landmarks, settings)
    once = np.kron(np.eye(2), root)  # of the largest kernels and of the means
    lift = np.zeros((2 * n + 1, 2 * n + 1))
    lift[:-1, :-1], lift[-1, -1] = once, 1
    plain = np.append(np.full(2 * n, 1e-2), 1e-6)
    above = np.triu_indices(2 * n + 1)
    before, v = None, np.zeros(2 * n + 1)
    for _ in range(settings.rounds):
        loss, tried = np.inf, v
        for _ in range(settings.steps):
            parts = np.split(sums(before, once @ v[:-1], v[-1]), 2)
            h, g, now = np.diag(plain), np.zeros(2 * n + 1), (plain * v * v).sum() / 2
            for part, sign in zip(parts, (1, -1)):
                share = settings.svm_c / max(1, part[0]) / 2  # both classes weigh the same
                now += share * part[1]
                g += 2 * share * sign * lift @ part[2 : 2 * n + 3]
                square = np.zeros((2 * n + 1, 2 * n + 1))
                square[above] = part[2 * n + 3 :]
                square.T[above] = part[2 * n + 3 :]
                h += 2 * share * lift @ square @ lift
            if now > loss + 1e-9:  # too far: halfway back
                v = (v + tried) / 2
                continue
            if loss - now < 1e-4 * max(now, 1e-9):
                break
            loss, tried = now, v
            v = np.linalg.solve(h, g)
        before = (once @ v[:-1], float(v[-1]))
    model = untrained(landmarks, settings) | {"weights": before[0], "bias": before[1]}
    toxic, margins, whole = gather(*before)
    labels = np.asarray(toxic, float)
    share = clean_per_toxic or (labels == 0).sum() / max(1, (labels == 1).sum())
    weight = np.where(labels == 1, 1.0, share * (labels == 1).sum() / max(1, (labels == 0).sum()))
    model["slope"], model["shift"] = map(float, _logistic(margins[:, None], labels, weight))
    spread = np.maximum(whole.std(axis=0), 1e-6)
    u = _logistic(whole / spread, labels, weight, settings.ridge * len(labels), model["slope"] * margins + model["shift"])
    model["whole"], model["shift"] = u[:-1] / spread, model["shift"] + float(u[-1])
    return model


def _margins(bags: Bags, weights: np.ndarray, bias: float) -> np.ndarray:
    """Each document's largest sentence margin."""
    out = np.full(len(bags.toxic), -np.inf)
    np.maximum.at(out, bags.doc, bags.rows @ weights.astype(np.float32) + np.float32(bias))
    return out


def _blocks(batch, column: int, most: int):
    """Slices of an Arrow batch with at most `most` characters or bytes in a column, or one row."""
    import pyarrow.compute as pc

    values = batch.column(column)
    sizes = (pc.binary_length(values) if str(values.type).endswith("binary") else pc.utf8_length(values)).fill_null(0).to_pylist()
    first = size = 0
    for i, n in enumerate(sizes):
        if i > first and size + n > most:
            yield batch.slice(first, i - first)
            first, size = i, 0
        size += n
    if first < batch.num_rows:
        yield batch.slice(first)


def _worker_scorer(token: str, model: dict) -> Scorer:
    """The worker's scorer of this model: its kernels serve all tasks that the worker runs."""
    state = worker_state("toxicity")
    if state.get("toxicity", (None,))[0] != token:
        state["toxicity"] = (token, Scorer(model))
    return state["toxicity"][1]


def _evidence(scorer: Scorer, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    words = [words_of(t) for t in texts]
    found = list(map(scorer.evidence, words, scorer.learn(words)))
    return [r for r, _ in found], [w for _, w in found]


def fit_texts(texts: list[str], toxic: np.ndarray, settings: Settings = Settings(), clean_per_toxic: float | None = None) -> dict:
    """The model from a few labelled texts (1 toxic, 0 not) in this process; `clean_per_toxic`:
    how many clean documents there are to a toxic one outside the sample."""
    from collections import Counter

    told = [(int(y), *_offers(text, settings)) for text, y in zip(texts, toxic)]
    n = [max(1, int((toxic == k).sum())) for k in (0, 1)]
    once, docs = (Counter(), Counter()), (Counter(), Counter())
    for w, _, y in {(w, copy, y) for y, copy, pieces in told for w in pieces}:
        once[y][w] += 1
    for y, _, pieces in told:
        docs[y].update(pieces)

    def rated(toxic, clean):
        found = sorted((-z_score(c, clean[w], n[1], n[0]), w) for w, c in toxic.items() if c >= settings.least_count)
        return [w for z, w in found if -z > settings.least_z and toxic[w] / n[1] > settings.lift * clean[w] / n[0]], [w for _, w in found]

    marked, _ = rated(once[1], once[0])
    uncovered = Counter()
    for y, _, pieces in told:
        if y and pieces.isdisjoint(marked):
            uncovered.update(pieces)
    ranked = marked + rated(uncovered, docs[0])[0] or rated(docs[1], docs[0])[1][: settings.fallback]
    landmarks = choose_landmarks(ranked, settings)
    scorer = Scorer(untrained(landmarks, settings))
    rows, whole = [], []
    for k in range(0, len(texts), 50):  # few texts at a time: their joined words take memory
        r, w = _evidence(scorer, texts[k : k + 50])
        rows, whole = rows + r, whole + w
    bags = Bags.of([int(y) for y in toxic], rows, whole, len(landmarks))
    return train(
        landmarks, settings, lambda before, w, b: svm_sums(bags, before, w, b), lambda w, b: (bags.toxic, _margins(bags, w, b), bags.whole), clean_per_toxic)


def held_out(doc_id):
    """crc32 of the id as text, mod 5, is 0."""
    return F.crc32(doc_id.cast("string")) % 5 == 0


def _sample(docs: DataFrame, labels: DataFrame, settings: Settings) -> tuple[DataFrame, dict] | None:
    """(doc_id, toxic, text of the fitting sample, staged; labelled documents by class), None without both classes."""
    usable = labels.select("doc_id", "toxic").where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    counts = {r["toxic"]: r["n"] for r in usable.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    picked = None
    for y in (0, 1):  # the smallest by hash: the same rows each time, wherever they lie
        some = usable.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.docs_per_class)
        picked = some if picked is None else picked.unionByName(some)
    rows = (
        docs.select("doc_id", "text").join(F.broadcast(picked.dropDuplicates(["doc_id"])), "doc_id")  # at most 2 x docs_per_class ids
        .select("toxic", F.coalesce("text", F.lit("")).alias("text"), "doc_id")
        .dropDuplicates(["doc_id"])
    )
    rows = stage(rows.repartition(SAMPLE_TASKS, "doc_id"), "toxic-sample")
    before = Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    lengths = rows.select("toxic", "doc_id", F.length("text").cast("long").alias("n"))  # at most 2 x docs_per_class rows, without their texts
    kept = lengths.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).where(F.col("before") < settings.chars)
    classes = {r["toxic"]: r["n"] for r in kept.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(classes) < 2:
        return None
    return rows.join(F.broadcast(kept.select("doc_id")), "doc_id", "left_semi"), {"sample": classes, "all": counts}


def _candidates(sample: DataFrame, n: dict, settings: Settings) -> list[str]:
    """Pieces that tell the classes apart, best first: counted on Spark, only those above the thresholds come here.

    Near copies count once at first: else the plain words of a toxic document
    that was often copied would tell the classes apart. Toxic documents in which
    that finds no piece then offer theirs, each counted.
    """

    def offers(covered):
        def run(batches):
            import pyarrow as pa

            for b in batches:
                told = [(y, *_offers(t or "", settings)) for y, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
                found = [(w, copy, y) for y, copy, pieces in told if covered is None or y and pieces.isdisjoint(covered) for w in pieces]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w for w, _, _ in found], pa.string()), pa.array([c for _, c, _ in found], pa.int64()), pa.array([y for _, _, y in found], pa.int64())],
                    names=["piece", "copies", "toxic"])

        return sample.select("toxic", "text").mapInArrow(run, "piece string, copies bigint, toxic bigint")

    def marked(rows, t, c):
        z = z_score(F.col(t), F.col(c), n[1], n[0])
        found = rows.where((F.col(t) >= settings.least_count) & (z > settings.least_z) & (F.col(t) / n[1] > settings.lift * F.col(c) / n[0]))
        return [r["piece"] for r in sorted(found.select("piece", z.alias("z")).collect(), key=lambda r: (-r["z"], r["piece"]))]

    groups = offers(None).groupBy("piece", "copies", "toxic").agg(F.count(F.lit(1)).alias("n"))
    counted = groups.groupBy("piece").agg(
        F.sum("toxic").alias("t_once"), F.sum(1 - F.col("toxic")).alias("c_once"),
        F.sum(F.col("toxic") * F.col("n")).alias("t"), F.sum((1 - F.col("toxic")) * F.col("n")).alias("c"))
    counted = stage(counted.where(F.col("t") >= settings.least_count), "toxic-pieces")
    first = marked(counted, "t_once", "c_once")
    left = offers(frozenset(first)).groupBy("piece").agg(F.count(F.lit(1)).alias("t")).where(F.col("t") >= settings.least_count)
    found = first + marked(left.join(counted.select("piece", "c"), "piece"), "t", "c")
    if not found:
        ranked = counted.orderBy(F.desc(z_score(F.col("t"), F.col("c"), n[1], n[0])), "piece").limit(settings.fallback)
        found = [r["piece"] for r in ranked.select("piece").collect()]
    return found


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> dict | None:
    """Fit on a bounded sample of the labelled documents that are not held out.

    Texts, words and evidence stay in Spark tables; the driver holds the
    candidates above the thresholds, the landmarks, sums of the evidence (its
    size is the landmarks' squared) and one vector for each sampled document.
    """
    found = _sample(docs, labels, settings)
    if found is None:
        return None
    sample, n = found
    landmarks = choose_landmarks(_candidates(sample, n["sample"], settings), settings)
    size, bare = len(landmarks), untrained(landmarks, settings)

    token = f"toxicity-{uuid4().hex}"

    def told(batches):
        import pyarrow as pa

        scorer = _worker_scorer(token, bare)
        for b in batches:
            for part in _blocks(b, 1, SAMPLE_BLOCK):
                rows, whole = _evidence(scorer, [t or "" for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([r.tobytes() for r in rows], pa.binary()), pa.array([w.tobytes() for w in whole], pa.binary())], names=["toxic", "rows", "whole"])

    evidence = stage(sample.select("toxic", "text", "doc_id").repartition(SAMPLE_TASKS, "doc_id").select(F.col("toxic").cast("int").alias("toxic"), "text").mapInArrow(
        told, "toxic int, rows binary, whole binary"), "toxic-evidence")

    def bags_of(b):
        toxic, rows, whole = (c.to_pylist() for c in b.columns)
        return Bags.of(toxic, [np.frombuffer(r, np.float32).reshape(-1, 2 * size) for r in rows], [np.frombuffer(w, np.float64) for w in whole], size)

    def sums(before, weights, bias):
        def run(batches):
            import pyarrow as pa

            total = None
            for b in batches:
                for some in _blocks(b, 1, EVIDENCE_BLOCK):
                    part = svm_sums(bags_of(some), before, weights, bias)
                    total = part if total is None else np.add(total, part, out=total)
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

        total = 0
        for r in evidence.coalesce(SUM_TASKS).mapInArrow(run, "sums binary").collect():
            total = total + np.frombuffer(r["sums"], np.float64)
        return total

    def gather(weights, bias):
        def run(batches):
            import pyarrow as pa

            for b in batches:
                for some in _blocks(b, 1, EVIDENCE_BLOCK):
                    yield pa.RecordBatch.from_arrays([some.column(0), pa.array(_margins(bags_of(some), weights, bias)), some.column(2)], names=["toxic", "margin", "whole"])

        rows = evidence.mapInArrow(run, "toxic int, margin double, whole binary").collect()  # one row for each document of the sample
        return np.array([r["toxic"] for r in rows]), np.array([r["margin"] for r in rows]), np.array([np.frombuffer(r["whole"], np.float64) for r in rows])

    return train(landmarks, settings, sums, gather, n["all"][0] / n["all"][1])


# ------------------------------------------------------------------ scoring


def score(docs: DataFrame, model: dict | None, text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The `carry` columns and `score` (0 to 1)."""
    if model is None:
        return docs.select(*carry, F.lit(0.0).alias("score"))
    kept = docs.select(*carry) if text in carry else docs.select(*carry, F.col(text).alias("_text"))
    at_text = carry.index(text) if text in carry else len(carry)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[: len(carry)])
    token = f"toxicity-{id(model)}-{float(np.sum(model['weights']))}"

    def run(batches):
        import pyarrow as pa

        scorer = _worker_scorer(token, model)
        for b in batches:
            for part in _blocks(b, at_text, SCORE_BLOCK):
                texts = [t or "" for t in part.column(at_text).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(len(carry))] + [pa.array(scorer.scores(texts), pa.float64())],
                    names=list(carry) + ["score"])

    return kept.mapInArrow(run, schema + ", score double")


def op7(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
