"""Toxicity by a support vector machine over a subsequence string kernel with Nyström landmarks.

The kernel of two strings sums over all subsequences of four characters, each weighed by
``DECAY`` to the power of the length it spans in either string, spans up to ``SPAN``; it is
normalized by the strings' lengths. Characters put between the letters of an insult only stretch its subsequences, so
``id-iot`` and ``i.d.i.o.t`` stay near ``idiot``.

Texts are read as units: words, neighbouring words as one string in which the space is a gap like
any other ("idi ot"), up to ``JOINED`` short words in a row as one ("id i ot"), runs of lone
characters, and overlapping windows of what is over-long. Units with spaces or marks inside are also
scored without them ("i--d--i--o--t"). A text is as toxic
as its worst unit, which is also how labels are learned: every unit of a clean text is clean, and a
toxic text vouches only for the units that its kind of text has and clean texts lack. Neighbouring
words are learned as toxic from the texts that no word explains.

Landmarks are units of the training texts. With K the landmarks' kernel matrix, the Nyström
features of a unit x are K^-1/2 k(x); a linear machine w on them is a weighted sum of kernels to
the landmarks. As the kernel is a dot product of subsequence counts, that sum folds into one
weight per subsequence, exactly, and scoring needs no landmark any more.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltgate.llm.common import held_in_worker, stage

DECAY = 0.85
SPAN = 7
LENGTH = 4
JOINED = 8  # short words in a row that are joined at most
LONGEST = 24  # longer words are read in windows of this length
# The documented bounds of what the model is fitted on.
TRAIN_TOXIC = 4_000
TRAIN_CLEAN = 8_000
LANDMARKS = 384
GUILTY = 1_000
INNOCENT = 4_000
ROUNDS = 2
MARGIN = "silt_margin"
# Training takes so many strings, pairs of their subsequences, and rows of features at once.
STRINGS = 500
PAIRS = 300_000
FEATURE_ROWS = 2_000
BLOCK_CHARS = 300_000  # texts are scored together until they have so many

_PATTERNS = [(0, a, b, c) for c in range(3, SPAN) for b in range(2, c) for a in range(1, b)]
_EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "¡¿«»„“”‘’…–—"
_LONE = re.compile(r"(?<!\S)\S(?:\s+\S){3,}(?!\S)")
_SHORT = re.compile(r"(?<!\S)\S{1,3}(?:\s+\S{1,3})+(?!\S)")
_MARKS = re.compile(r"[^\w\s]+|_+")
_GAPS = re.compile(r"[\W_]+")


def units(text: str | None) -> set[str]:
    """The raw units of a text: its words, its pairs of neighbours, and its runs of short words joined."""
    if not text:
        return set()
    lowered = text.lower()
    words = lowered.split()
    found = set(words)
    found.update(map(" ".join, zip(words, words[1:])))
    for run in _LONE.findall(lowered):
        found.add("".join(run.split()))
    for run in _SHORT.findall(lowered):
        parts = run.split()
        for size in range(3, min(len(parts), JOINED) + 1):
            found.update("".join(parts[i : i + size]) for i in range(len(parts) - size + 1))
    return found


def windows(unit: str, gaps: re.Pattern[str] = _GAPS) -> list[str]:
    """The strings a unit is compared by: itself without outer punctuation, or windows of it; then the same without gaps.

    Training takes marks alone as gaps, so that a pair of words stays one. Units of two and three characters are framed, so that they have subsequences.
    """
    bare = unit.strip(_EDGES)
    found = _cut(bare)
    if not bare.isalnum():
        plain = gaps.sub("", bare)
        if plain != bare:
            found += _cut(plain)
    return found


def _cut(bare: str) -> list[str]:
    if len(bare) <= LONGEST:
        return [bare] if len(bare) >= LENGTH else [f"\x02{bare}\x03"] if len(bare) > 1 else []
    step = LONGEST // 2
    return [bare[i : i + LONGEST] for i in range(0, len(bare) - step, step)]


# Characters are told apart as one of 64 classes: a to z, and the others dealt over the rest.
_CLASS = np.array([i - 96 if 97 <= i <= 122 else 27 + i % 37 for i in range(1 << 16)], dtype=np.int32)


def by_length(strings: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, characters) of the strings of each length that has subsequences at all."""
    lengths = np.fromiter(map(len, strings), dtype=np.int64, count=len(strings))
    for length in np.unique(lengths):
        if length >= LENGTH:
            at = np.flatnonzero(lengths == length)
            joined = "".join([strings[i] for i in at]).encode("utf-32-le", "surrogatepass")
            yield at, _CLASS[np.frombuffer(joined, dtype="<u4") & 0xFFFF].reshape(len(at), length)


def coded(chars: np.ndarray) -> Iterator[tuple[np.ndarray, float]]:
    """(codes, value) of the subsequences of strings of one length, a pattern of places at a time."""
    length = chars.shape[1]
    patterns = [p for p in _PATTERNS if p[-1] < length]
    norm = sum((length - p[-1]) * DECAY ** (2 * p[-1] + 2) for p in patterns) ** 0.5
    for places in patterns:
        span = places[-1]
        code = chars[:, : length - span]
        for place in places[1:]:
            code = (code << 6) | chars[:, place : length - span + place]
        yield code, DECAY ** (span + 1) / norm


def subsequences(strings: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string number, subsequence code, value) of all strings; a code may come several times."""
    rows, codes, values = [np.empty(0, np.int64)], [np.empty(0, np.int32)], [np.empty(0)]
    for at, chars in by_length(strings):
        for code, value in coded(chars):
            rows.append(np.repeat(at, code.shape[1]))
            codes.append(code.ravel())
            values.append(np.full(code.size, value))
    return np.concatenate(rows), np.concatenate(codes), np.concatenate(values)


def kernel(left: list[str], right: list[str]) -> np.ndarray:
    """The kernel of every left and right string.

    Occurrences of the same subsequence are paired, a bounded number at a time; there is no table
    of strings by subsequences.
    """
    rr, rc, rv = subsequences(right)
    order = np.argsort(rc, kind="stable")
    rr, rv = rr[order], rv[order]
    known, begins, counts = np.unique(rc[order], return_index=True, return_counts=True)
    out = np.zeros((len(left), len(right)))
    if not len(known):
        return out
    for start in range(0, len(left), STRINGS):
        part = out[start : start + STRINGS]
        lr, lc, lv = subsequences(left[start : start + STRINGS])
        at = np.minimum(np.searchsorted(known, lc), len(known) - 1)
        hit = known[at] == lc
        lr, lv, at = lr[hit], lv[hit], at[hit]
        ends = np.cumsum(counts[at])
        done = 0
        while done < len(at):
            before = ends[done - 1] if done else 0
            stop = max(done + 1, int(np.searchsorted(ends, before + PAIRS, side="right")))
            n = counts[at[done:stop]]
            which = np.repeat(np.arange(done, stop), n)
            place = np.arange(len(which)) - np.repeat(np.cumsum(n) - n - begins[at[done:stop]], n)
            cell = lr[which] * len(right) + rr[place]
            part += np.bincount(cell, lv[which] * rv[place], minlength=part.size).reshape(part.shape)
            done = stop
    return out


def cosines(strings: list[str]) -> np.ndarray:
    found = kernel(strings, strings)
    size = np.sqrt(np.maximum(np.diag(found), 1e-12))
    return found / size[:, None] / size[None, :]


_NORMS = np.array(
    [
        sum((length - p[-1]) * DECAY ** (2 * p[-1] + 2) for p in _PATTERNS if p[-1] < length) ** 0.5 or 1.0
        for length in range(LONGEST + 1)
    ]
)
_SPANS = range(LENGTH - 1, SPAN)


@dataclass
class Model:
    """One weight per subsequence, a bias, and the logistic curve of the score."""

    codes: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float = 4.0
    middle: float = 0.0
    # Look-ups a worker makes once: a few MB each.
    table: tuple[np.ndarray, np.ndarray] | None = field(default=None, repr=False)
    framed: np.ndarray | None = field(default=None, repr=False)
    kinds: tuple[np.ndarray, np.ndarray, np.ndarray] | None = field(default=None, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "table": None, "framed": None, "kinds": None}

    def blocks(self) -> tuple[np.ndarray, np.ndarray]:
        """(where the block of a first pair of characters begins, weights by block and second pair).

        Pairs that begin no subsequence of the model share a block of zeros, which is where
        most of a text looks, so the looks stay in the processor's cache.
        """
        if self.table is None:
            first = np.unique(self.codes >> 12)
            begins = np.zeros(1 << 12, dtype=np.int32)
            begins[first] = np.arange(1, len(first) + 1, dtype=np.int32) << 12
            weights = np.zeros((len(first) + 1) << 12, dtype=np.float32)
            weights[begins[self.codes >> 12] + (self.codes & 0xFFF)] = self.weights
            self.table = begins, weights
        return self.table

    def weight_of(self, code: np.ndarray) -> np.ndarray:
        begins, weights = self.blocks()
        return weights[begins[code >> 12] + (code & 0xFFF)]

    def sums(self, strings: list[str]) -> np.ndarray:
        """The weighted sum of each string's subsequences."""
        out = np.zeros(len(strings))
        for at, chars in by_length(strings):
            for code, value in coded(chars):
                out[at] += value * self.weight_of(code).sum(axis=1)
        return out

    def margins(self, found: list[str]) -> np.ndarray:
        """The machine's decision for each raw unit: the largest of its windows, or the bias."""
        owner, strings = [], []
        for i, unit in enumerate(found):
            for window in windows(unit):
                owner.append(i)
                strings.append(window)
        out = np.full(len(found), self.bias)
        if not strings or not len(self.codes):
            return out
        np.maximum.at(out, owner, self.sums(strings) + self.bias)
        return out

    def short_sums(self) -> np.ndarray:
        """The sums of all framed strings of two and three characters, by their classes."""
        if self.framed is None:
            classes = np.arange(1 << 18, dtype=np.int32)
            inner = [(classes >> shift) & 63 for shift in (12, 6, 0)]
            first, last = (np.full(len(classes), _CLASS[c], dtype=np.int32) for c in (2, 3))
            out = np.zeros((2, len(classes)))
            for row, chars in ((0, [first, inner[1], inner[2], last]), (1, [first, *inner, last])):
                for code, value in coded(np.stack(chars, axis=1)):
                    out[row] += value * self.weight_of(code).sum(axis=1)
            self.framed = out
        return self.framed

    def worst(self, texts: list[str | None]) -> Iterator[float]:
        """The largest margin of each text's units; the bias for a text without any."""
        block: list[str] = []
        held = 0
        for text in texts:
            block.append(text.lower() if text else "")
            held += len(block[-1])
            if held >= BLOCK_CHARS:
                yield from self._worst_of(block)
                block, held = [], 0
        yield from self._worst_of(block)

    def _worst_of(self, block: list[str]) -> Iterator[float]:
        """The same for some lowered texts: every window of every unit from running sums."""
        best = np.full(len(block), -np.inf)
        if len(self.codes):
            self.kinds = self.kinds or _kinds()
            for chars, owner, start, stop in spelled(block, *self.kinds):
                np.maximum.at(best, owner, self._window_sums(chars, start, stop))
        return iter(np.maximum(best, 0.0) + self.bias)

    def _window_sums(self, chars: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """The normalized sums of the windows [start, stop) of a row of character classes."""
        length = stop - start
        out = np.full(len(start), -np.inf)
        fits = np.flatnonzero(length >= LENGTH)
        first, last, size = start[fits], stop[fits], length[fits]
        total = np.zeros(len(fits))
        for span, running in self._running(chars):
            total += np.where(size > span, running[np.maximum(last - span, first)] - running[first], 0.0)
        out[fits] = total / _NORMS[size]
        for row, size in ((0, 2), (1, 3)):
            framed = np.flatnonzero(length == size)
            code = np.zeros(len(framed), dtype=np.int64)
            for i in range(size):
                code = (code << 6) | chars[start[framed] + i]
            out[framed] = self.short_sums()[row][code]
        return out

    def _running(self, chars: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(span, running sums): what the subsequences of each span that begin before a place weigh."""
        (begins, weights), n = self.blocks(), len(chars)
        pairs = {d: (chars[: n - d] << 6) | chars[d:] for d in range(1, SPAN) if d < n}
        first = {d: begins[found] for d, found in pairs.items() if d < SPAN - 2}
        for span in _SPANS:
            running = np.zeros(n + 1)
            if n > span:
                here = np.zeros(n - span, dtype=np.float32)
                for _, a, b, c in _PATTERNS:
                    if c == span:
                        here += weights[first[a][: n - span] + pairs[c - b][b : b + n - span]]
                np.cumsum(here, dtype=np.float64, out=running[1 : n - span + 1])
                running[n - span + 1 :] = running[n - span]
                running *= DECAY ** (span + 1)
            yield span, running


# --- units as places in a row of characters -----------------------------------------


def _kinds() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By code point: whether it is white space, a letter or digit, or one of the outer marks."""
    every = [chr(c) for c in range(0x110000)]
    blank = np.fromiter((c.isspace() for c in every), dtype=bool, count=len(every))
    alnum = np.fromiter((c.isalnum() for c in every), dtype=bool, count=len(every))
    edge = np.zeros(len(every), dtype=bool)
    edge[[ord(c) for c in _EDGES]] = True
    return blank, alnum, edge


def spelled(
    block: list[str], blank: np.ndarray, alnum: np.ndarray, edge: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(character classes, text number, start, stop) of all windows that ``windows`` gives for the
    units of some lowered texts, in three spellings: words one space apart, letters and digits
    alone, and runs of short words without their spaces."""
    joined = "\n".join(block) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    sizes = np.fromiter(map(len, block), dtype=np.int64, count=len(block)) + 1
    inside = ~blank[codes]
    turn = np.flatnonzero(np.diff(inside, prepend=False))
    start, stop = turn[0::2], turn[1::2]  # of words
    n = len(start)
    if not n:
        return
    text = np.searchsorted(np.cumsum(sizes), start, side="right")
    plain = alnum[codes]
    letters = np.concatenate([[0], np.cumsum(plain)])  # before each place
    clean = letters[stop] - letters[start] == stop - start
    classes = _CLASS[codes & 0xFFFF]
    next_same = np.zeros(n, dtype=bool)
    next_same[:-1] = text[1:] == text[:-1]
    first = np.flatnonzero(next_same)  # words with a neighbour after them
    # Where a word begins and ends without its outer marks; an empty one begins at its end.
    solid = np.flatnonzero(inside & ~edge[codes])
    solid = np.append(solid, len(codes))
    low = np.minimum(solid[np.searchsorted(solid, start)], stop)
    high = np.where(low < stop, solid[np.searchsorted(solid, stop) - 1] + 1, stop)

    # Words one space apart: a word's place is the letters before it and a space for each word.
    kept = inside.copy()
    kept[stop] = True
    place = np.concatenate([[0], np.cumsum(kept)])
    row = np.where(inside, classes, _CLASS[32])[kept]
    # A neighbour of marks alone is stripped to the space.
    left = np.where(low[first] < stop[first], low[first], stop[first])
    right = np.where(low[first + 1] < stop[first + 1], high[first + 1], start[first + 1])
    lone = (low[first] >= stop[first]) & (low[first + 1] >= stop[first + 1])
    pair_left, pair_right = place[left], place[right]
    yield row, *_windows_of(
        np.concatenate([text, text[first][~lone]]),
        np.concatenate([place[low], pair_left[~lone]]),
        np.concatenate([place[high], pair_right[~lone]]),
    )

    # Letters and digits alone, for units that have anything else: words with marks, all pairs,
    # and short words in a row.
    runs_owner, runs_start, runs_stop, marked = _short_runs(text, stop - start, clean)
    marked_words = np.flatnonzero(~clean)
    yield classes[plain], *_windows_of(
        np.concatenate([text[marked_words], text[first], runs_owner]),
        letters[np.concatenate([start[marked_words], start[first], start[runs_start]])],
        letters[np.concatenate([stop[marked_words], stop[first + 1], stop[runs_stop]])],
    )
    # The same runs with their inner marks.
    owner, begin, end = runs_owner[marked], runs_start[marked], runs_stop[marked]
    if len(owner):
        # Words at the ends that are marks alone go with their marks.
        used = np.zeros(n + 1, dtype=np.int64)
        np.add.at(used, begin, 1)
        np.add.at(used, end + 1, -1)
        word_used = np.cumsum(used)[:n] > 0
        mask = np.zeros(len(codes) + 1, dtype=np.int64)
        mask[start[word_used]] += 1
        mask[stop[word_used]] -= 1
        mask = np.cumsum(mask)[: len(codes)] > 0
        at = np.concatenate([[0], np.cumsum(mask)])
        inner, outer = np.searchsorted(solid, start[begin]), np.searchsorted(solid, stop[end])
        some = inner < outer  # a run of marks alone has nothing
        yield classes[mask], *_windows_of(owner[some], at[solid[inner[some]]], at[solid[outer[some] - 1] + 1])


def _windows_of(owner: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Units as they are, but over-long ones in overlapping windows, as ``_cut`` cuts them."""
    length = stop - start
    short = (length <= LONGEST) & (length > 1)
    long = np.flatnonzero(length > LONGEST)
    if not len(long):
        return owner[short], start[short], stop[short]
    step = LONGEST // 2
    counts = -(-(length[long] - step) // step)
    which = np.repeat(long, counts)
    number = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
    begin = start[which] + number * step
    return (
        np.concatenate([owner[short], owner[which]]),
        np.concatenate([start[short], begin]),
        np.concatenate([stop[short], np.minimum(begin + LONGEST, stop[which])]),
    )


def _short_runs(
    text: np.ndarray, length: np.ndarray, clean: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, last word, whether any word has marks) of the joined units: three to
    ``JOINED`` short words in a row, and all of four or more lone characters in a row."""
    n = len(text)
    marks_before = np.concatenate([[0], np.cumsum(~clean)])
    first: list[np.ndarray] = []
    last: list[np.ndarray] = []
    for size_limit in (3, 1):
        member = length <= size_limit
        begins = np.flatnonzero(member & ~np.concatenate([[False], member[:-1] & (text[1:] == text[:-1])]))
        # A run ends where the next word is no member or of another text.
        goes_on = np.concatenate([member[1:] & (text[1:] == text[:-1]), [False]])
        ends = np.flatnonzero(member & ~goes_on)
        if size_limit == 1:
            chosen = ends - begins >= 3
            first.append(begins[chosen])
            last.append(ends[chosen])
            continue
        run = np.zeros(n, dtype=np.int64)
        run[begins] = 1
        end_of = np.full(n, -1, dtype=np.int64)
        in_run = np.flatnonzero(member)
        end_of[in_run] = ends[np.cumsum(run)[in_run] - 1]
        for size in range(3, JOINED + 1):
            begin = in_run[in_run + size - 1 <= end_of[in_run]]
            first.append(begin)
            last.append(begin + size - 1)
    begin, end = np.concatenate(first), np.concatenate(last)
    return text[begin], begin, end, marks_before[end + 1] > marks_before[begin]


# --- training -------------------------------------------------------------------


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a row belongs to the fold no label is learned from; a null id does."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def _sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Texts of at most TRAIN_TOXIC + TRAIN_CLEAN labelled rows of the learning folds, by hash of the id."""
    usable = labels.where(F.col("toxic").isin(0, 1) & ~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    usable = usable.withColumn("place", F.xxhash64("doc_id"))
    toxic = usable.where("toxic = 1").orderBy("place").limit(TRAIN_TOXIC)
    clean = usable.where("toxic = 0").orderBy("place").limit(TRAIN_CLEAN)
    chosen = toxic.unionAll(clean).drop("place")
    # At most TRAIN_TOXIC + TRAIN_CLEAN ids.
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def _unit_counts(sample: DataFrame) -> DataFrame:
    """Rows (unit, toxic, clean): in how many sampled texts of each label a unit occurs."""

    def run(batches):
        for batch in batches:
            texts, marks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            unit, toxic = [], []
            for text, mark in zip(texts, marks):
                found = {w for u in units(text) for w in windows(u, _MARKS)}
                unit += found
                toxic += [mark] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(unit, pa.string()), pa.array(toxic, pa.int32())], ["unit", "toxic"])

    found = sample.select("text", F.col("toxic").cast("int")).mapInArrow(run, "unit string, toxic int")
    return found.groupBy("unit").agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean"))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from a bounded sample of labelled texts. Without toxic or clean ones it scores all alike, low.

    Clean units to learn from are a hashed sample at first; in each further round the units of
    clean texts that the machine so far finds worst join them.
    """
    sample = _sample(docs, labels)
    counts = stage(_unit_counts(sample), "units")
    sizes = sample.agg(F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") == 0)).first()
    if not all(sizes):
        return Model(np.empty(0, np.int32), np.empty(0), -1.0)
    # How much likelier in toxic than in clean texts, shrunk for rare units.
    lift = F.log((F.col("toxic") + 0.1) / sizes[0]) - F.log((F.col("clean") + 0.3) / sizes[1])
    rated = counts.withColumn("rate", F.col("toxic") * lift)
    pair = F.col("unit").contains(" ")
    top, beside = (
        rated.where("toxic >= 2 and rate > 0").where(kind).orderBy(F.desc("rate"), "unit").limit(GUILTY).collect() for kind in (~pair, pair)
    )
    guilty = [(r["unit"], r["toxic"], r["clean"]) for r in top]
    innocent = {
        r["unit"]: r["clean"]
        for kind in (pair, ~pair)
        for r in counts.where("clean > 0").where(kind).orderBy(F.xxhash64("unit"), "unit").limit(INNOCENT).collect()
    }
    seen = _occurrences(sample, [r["unit"] for r in (*top, *beside)])
    bad = witnesses(guilty, [[i for i in row if i < len(top)] for row in seen], sizes)
    # Pairs count by the texts that no word explains.
    telling = {u for u, _ in bad}
    rest = [{i - len(top) for i in row if i >= len(top)} for row in seen if not any(i < len(top) and top[i]["unit"] in telling for i in row)]
    left = [sum(i in row for row in rest) for i in range(len(beside))]
    pairs = [(r["unit"], n, r["clean"]) for r, n in zip(beside, left)]
    bad += witnesses(pairs, [sorted(row) for row in rest], sizes)
    model = fit(bad, innocent)
    for _ in range(ROUNDS):
        rated = _unit_margins(counts.where("clean > 0").select("unit", "clean"), model)
        worst = rated.orderBy(F.desc("margin"), "unit").limit(INNOCENT // 2).collect()
        innocent |= {r["unit"]: r["clean"] for r in worst}
        model = fit(bad, innocent)
    return _calibrated(model, sample)


def _occurrences(sample: DataFrame, names: list[str]) -> list[list[int]]:
    """For each toxic text of the sample the numbers of the named units in it (both bounded)."""
    number = {n: i for i, n in enumerate(names)}

    def run(batches):
        for batch in batches:
            found = [
                [number[w] for u in units(text) for w in windows(u, _MARKS) if w in number] for text in batch.column(0).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32()))], ["units"])

    return [r["units"] for r in sample.where("toxic = 1").select("text").mapInArrow(run, "units array<int>").collect()]


def witnesses(
    guilty: list[tuple[str, int, int]], seen: list[list[int]], sizes: tuple[int, int]
) -> list[tuple[str, int]]:
    """Units, with counts, that together explain the toxic texts.

    Greedily the unit that is most telling in the texts not explained yet is taken, so what only
    accompanies an insult (as in a group of copies) is not. Units as pure as those taken and
    close to one of them are taken as well.
    """
    toxic = np.array([g[1] for g in guilty], dtype=float)
    clean = np.array([g[2] for g in guilty], dtype=float)
    pure = toxic / sizes[0] > 30 * (clean + 0.01) / sizes[1]
    table = np.zeros((len(seen), len(guilty)), dtype=bool)
    for row, found in enumerate(seen):
        table[row, found] = True
    # What many toxic texts and no clean one have needs no comparison.
    taken = np.flatnonzero(pure & (clean == 0) & (toxic >= max(6, 0.04 * sizes[0]))).tolist()
    rest = ~table[:, taken].any(axis=1)
    while rest.any() and len(guilty):
        left = table[rest].sum(axis=0)
        value = np.where(pure, left * (np.log((left + 0.1) / sizes[0]) - np.log((clean + 0.3) / sizes[1])), 0.0)
        best = int(value.argmax())
        if value[best] <= 0 or left[best] < 3:
            break
        taken.append(best)
        rest &= ~table[:, best]
    if not taken:
        return []
    near = cosines([g[0] for g in guilty])[:, taken].max(axis=1)
    return [(g[0], g[1]) for i, g in enumerate(guilty) if i in set(taken) or (pure[i] and near[i] > 0.25)]


def _unit_margins(found: DataFrame, model: Model) -> DataFrame:
    def run(batches):
        for batch in batches:
            values = model.margins(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(values)], ["unit", "clean", "margin"])

    return found.mapInArrow(run, "unit string, clean bigint, margin double")


def disguises(unit: str) -> list[str]:
    return [unit, *(f"{unit[:i]}-{unit[i:]}" for i in range(1, len(unit))), ".".join(unit)]


def fit(guilty: list[tuple[str, int]], innocent: dict[str, int]) -> Model:
    """The machine over Nyström features, folded into weights of subsequences.

    ``guilty`` units, with their counts in toxic texts, are learned as toxic, ``innocent`` ones,
    with their counts in clean texts, as clean.
    """
    if not guilty:
        return Model(np.empty(0, np.int32), np.empty(0), -1.0)
    # Each also as people disguise it: one character inside, or one between all letters.
    shown = [(v, g[1] / (1.0 if v == g[0] else len(g[0]))) for g in guilty for v in dict.fromkeys(disguises(g[0]))]
    positive = [g[0] for g in guilty]
    chosen = set(positive)
    # Clean pairs are shown as they are scored, with their space and without.
    weighed = {v: n for u, n in innocent.items() for v in (u.replace(" ", ""), u)}
    negative = [u for u in weighed if u not in chosen]
    # Units first, then the disguises of the strongest.
    marks = list(dict.fromkeys([*positive, *(v for v, _ in shown)]))[: 3 * LANDMARKS // 4]
    # The hardest clean units come last.
    marks += negative[::-1][: LANDMARKS - len(marks)]
    positive = [v for v, _ in shown]
    weight = np.r_[np.sqrt([n for _, n in shown]), np.sqrt([weighed[u] for u in negative])]
    weight[: len(positive)] *= weight[len(positive) :].sum() / weight[: len(positive)].sum()
    strings, labels = positive + negative, np.r_[np.ones(len(positive)), -np.ones(len(negative))]
    values, vectors = np.linalg.eigh(kernel(marks, marks))
    keep = values > 1e-6 * values.max()
    half = vectors[:, keep] / np.sqrt(values[keep]) @ vectors[:, keep].T
    features = np.empty((len(strings), len(marks)))
    for start in range(0, len(strings), FEATURE_ROWS):
        features[start : start + FEATURE_ROWS] = kernel(strings[start : start + FEATURE_ROWS], marks) @ half
    w, bias = _svm(features, labels, weight)
    folded = half @ w  # one weight per landmark
    row, code, value = subsequences(marks)
    codes, place = np.unique(code, return_inverse=True)
    return Model(codes, np.bincount(place, value * folded[row]), float(bias))


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-4) -> tuple[np.ndarray, float]:
    """A linear machine with squared hinge loss by Newton's method on its support vectors."""
    m = x.shape[1]
    penalty = np.eye(m + 1) * ridge * weight.sum()
    penalty[-1, -1] = 1e-9
    w = np.zeros(m + 1)
    for _ in range(50):
        square, goal = penalty.copy(), np.zeros(m + 1)
        for start in range(0, len(x), FEATURE_ROWS):
            block = slice(start, start + FEATURE_ROWS)
            rows = np.c_[x[block], np.ones(len(x[block]))]
            active = y[block] * (rows @ w) < 1
            part = rows[active] * weight[block][active, None]
            square += part.T @ rows[active]
            goal += part.T @ y[block][active]
        new = np.linalg.solve(square, goal)
        if np.allclose(new, w, atol=1e-8):
            break
        w = new
    return w[:-1], w[-1]


def _calibrated(model: Model, sample: DataFrame) -> Model:
    """The logistic curve that fits the margins of the sampled texts (two numbers each, so bounded)."""
    scored = margins(sample, model, "toxic").collect()
    margin = np.array([r[MARGIN] for r in scored])
    label = np.array([r["toxic"] for r in scored], dtype=float)
    # Smoothed targets and a small penalty keep the curve gentle where the labels separate.
    n1, n0 = label.sum(), len(label) - label.sum()
    goal = np.where(label == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.c_[margin, np.ones(len(margin))]
    penalty = np.diag([1.0, 1e-6])

    def loss(w):
        z = x @ w
        return np.logaddexp(0, z).sum() - goal @ z + 0.5 * w @ penalty @ w

    w = np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (p - goal) + penalty @ w)
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    if w[0] <= 0.1:
        w = np.array([4.0, 0.0])
    model.slope, model.middle = float(w[0]), float(-w[1] / w[0])
    return model


# --- scoring --------------------------------------------------------------------


def margins(docs: DataFrame, model: Model, *keep: str) -> DataFrame:
    """The columns ``keep`` of ``docs`` with ``MARGIN``, that of the whole text."""
    narrow = docs.select(*[f"`{k}`" for k in keep], "text")

    def run(batches):
        shared = _in_worker(model)
        for batch in batches:
            found = list(shared.worst(batch.column(batch.num_columns - 1).to_pylist()))
            columns = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.float64())], [*keep, MARGIN])

    schema = [f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keep]
    return narrow.mapInArrow(run, ", ".join([*schema, f"{MARGIN} double"]))


def _in_worker(model: Model) -> Model:
    """The same model object for all tasks of a worker process, with what it has scored."""
    return held_in_worker(("toxicity", model.weights.tobytes()), lambda: model)


def _curve(model: Model) -> Column:
    return 1 / (1 + F.exp(F.lit(-model.slope) * (F.col(MARGIN) - F.lit(model.middle))))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Every row of ``docs`` with ``score`` (0 to 1) and ``predicted`` (1 if 0.5 or more) added.

    A null, empty or blank text has no unit and gets the score of the bias. Scores depend on the
    text alone, so repeated rows agree. All other columns come back as they are; of columns that
    are called ``score`` or ``predicted`` already the model's take the place.
    """
    return score_columns(docs, model, *[c for c in docs.columns if c not in ("score", "predicted")])


def score_columns(docs: DataFrame, model: Model, *keep: str) -> DataFrame:
    scored = margins(docs, model, *keep).withColumn("score", _curve(model)).drop(MARGIN)
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` the model does not reject, as they are, whatever their columns are called."""
    return margins(docs, model, *docs.columns).where(_curve(model) < 0.5).drop(MARGIN)
