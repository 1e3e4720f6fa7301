"""Class-based n-grams: exchange clustering of words, and scores from classes.

The probability of a word is that of its class after the class before it, times that of the word
in its class. Words seen ``frequent`` times or more are clustered by exchange: a word moves to the
class in which the likelihood of the class bigrams becomes largest; the most frequent words begin
as a class each. Rarer ones share a class with those of the same count (by powers of two), and words
never seen are a share of the class of words seen once. The end of a text is a class of its own, and
stands before its first word.

A round is so many turns. A word's hash says in which turn it may move; the words of a turn are
judged each by itself against the same table of class bigrams, which is counted anew for the next
turn. So classes depend on the corpus alone, not on partitions, buckets or settings. A turn after
which the likelihood is not higher is taken back.

Texts are kept as places in a dictionary for each chunk of some megabytes, so that the tables of
all words, which grow with the corpus, meet dictionaries and never single tokens. What the driver
holds is the table of class bigrams, which has a fixed size. Words are told apart by a 64-bit hash;
frequent ones are known by bucket and rank in it, so that what is dealt out in each round are small
differences between ranks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.session import written
from llm.common import chunks, each, grow, in_place, joined, mix, packed, rows, shrink, word_parts, words

CLASSES = 32
#: A word is clustered from so many training tokens on.
FREQUENT = 32
ROUNDS = 2
#: Turns of a round.
TURNS = 4
#: Entries of chunk dictionaries in a bucket of words.
BUCKET = 1 << 18
#: Classes by count of rarer words, the end, and what is before: see ``_rare``.
_RARE = 6
#: Share of the class of words seen once that is kept for words never seen.
UNSEEN = 0.5
_SMOOTH = 0.5
_END = np.uint64(0x5EED0FE4D0F7E875)


@dataclass(frozen=True)
class Shape:
    classes: int = CLASSES
    frequent: int = FREQUENT
    #: The most frequent words (bucket << 32 | rank), which begin as a class each.
    seeds: tuple[int, ...] = ()

    @property
    def total(self) -> int:
        return self.classes + _RARE + 1

    @property
    def end(self) -> int:
        return self.classes + _RARE

    def start(self, number: np.ndarray) -> np.ndarray:
        """The class of frequent words before clustering: the seeds' own, or the last."""
        out = np.full(len(number), self.classes - 1, np.uint8)
        for k, seed in enumerate(self.seeds):
            out[number == seed] = k
        return out

    def rare(self, counts: np.ndarray) -> np.ndarray:
        """The class of other words, by count; words never seen are with those seen once."""
        power = np.floor(np.log2(np.maximum(counts, 1))).astype(np.int64)
        return (self.classes + np.minimum(power, _RARE - 1)).astype(np.uint8)


_CHUNK = pa.schema(
    [
        ("chunk", pa.int64()), ("names", pa.binary()), ("counts", pa.binary()),
        ("doc_id", pa.list_(pa.int64())), ("held_out", pa.binary()), ("sizes", pa.binary()),
        ("places", pa.binary()), ("n", pa.int64()),
    ]
)
_KIND = (
    "chunk long, names binary, counts binary, doc_id array<long>, held_out binary, sizes binary, "
    "places binary, n long"
)


def encoded(docs: DataFrame, chunk_bytes: int = 8 << 20) -> DataFrame:
    """One row for each chunk: its distinct words with training counts, and texts as places.

    ``docs`` has doc_id, text and held_out.
    """

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        for batch in chunks(batches, chunk_bytes):
            n = batch.num_rows
            row, word = [], []
            for number_of, part in word_parts(batch.column("text")):
                r, w = words(part)
                row.append(number_of[r])
                word.append(w)
            row = np.concatenate([*row, np.arange(n)])
            word = np.concatenate([*word, np.full(n, _END)])
            order = np.argsort(row, kind="stable")
            row, word = row[order], word[order]
            names, place, times = np.unique(word, return_inverse=True, return_counts=True)
            # Frequent words first: small numbers, which compress well.
            order = np.argsort(-times, kind="stable")
            rank = np.empty(len(names), np.int64)
            rank[order] = np.arange(len(names))
            names, place = names[order], rank[place]
            out = np.array(batch.column("held_out").to_pylist(), bool)
            counts = np.bincount(place[~out[row]], minlength=len(names))
            yield rows(
                _CHUNK,
                [
                    (
                        number, names.tobytes(), counts.astype(np.uint32).tobytes(),
                        batch.column("doc_id").to_pylist(), out.tobytes(),
                        np.bincount(row, minlength=n).astype(np.uint32).tobytes(),
                        shrink(place), int(counts.sum()),
                    )
                ],
            )
            number += 1

    return docs.select(F.col("doc_id").cast("long"), "text", "held_out").mapInArrow(run, _KIND)


def _bucket(names: np.ndarray, count: int) -> np.ndarray:
    return (mix(names) % np.uint64(count)).astype(np.int64)


def _dictionaries(count: int):
    """Chunk dictionaries dealt out by hash of the word."""

    def run(batches):
        for row in each(batches):
            names = np.frombuffer(row["names"], np.uint64)
            counts = np.frombuffer(row["counts"], np.uint32)
            parts = list(packed(_bucket(names, count), count, names, counts))
            if parts:
                b, n, c = zip(*parts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(b, pa.int32()), pa.array([row["chunk"]] * len(b), pa.int64()),
                        pa.array(n, pa.binary()), pa.array(c, pa.binary()),
                    ],
                    ["bucket", "chunk", "names", "counts"],
                )

    return run


def _wide(counts: np.ndarray) -> bytes:
    """Counts of any size, compressed."""
    counts = counts.astype(np.int64)
    return shrink(counts & 0xFFFFFFFF, counts >> 32)


def _narrow(blob: bytes) -> np.ndarray:
    low, high = grow(blob, 2)
    return low.astype(np.int64) | high.astype(np.int64) << 32


def _steps(ranks: np.ndarray) -> np.ndarray:
    """Rising ranks as differences, which compress well."""
    return np.diff(ranks, prepend=0)


def _ranks(steps: np.ndarray) -> np.ndarray:
    return np.cumsum(steps.astype(np.int64))


def _count(shape: Shape):
    """Of one bucket: the counts of each chunk's words in all training texts and the ranks of the
    frequent ones, and (chunk null) the frequent words with their counts."""

    def run(table: pa.Table) -> pa.Table:
        blobs = table.column("names").to_pylist()
        names = joined(blobs, np.uint64)
        counts = joined(table.column("counts").to_pylist(), np.uint32)
        distinct, which = np.unique(names, return_inverse=True)
        total = np.bincount(which, counts, len(distinct)).astype(np.int64)
        often = (total >= shape.frequent) & (distinct != _END)
        ends = np.cumsum([len(x) // 8 for x in blobs])
        parts = np.split(which, ends[:-1])
        rank = np.cumsum(often) - 1
        ranks = [shrink(_steps(np.sort(rank[x[often[x]]]))) for x in parts]
        one = lambda x, kind: pa.array([None] * len(blobs) + [x], kind)
        bucket = table.column("bucket").to_pylist()
        return pa.table(
            {
                "chunk": pa.array(table.column("chunk").to_pylist() + [None], pa.int64()),
                "bucket": pa.array(bucket + bucket[:1], pa.int32()),
                "counts": pa.array([_wide(total[x]) for x in parts] + [None], pa.binary()),
                "ranks": pa.array(ranks + [None], pa.binary()),
                "names": one(distinct[often].tobytes(), pa.binary()),
                "often": one(total[often].tobytes(), pa.binary()),
                "v": one(int((total > 0).sum()), pa.int64()),
            }
        )

    return run


def _seeds(words_: DataFrame, most: int) -> tuple[int, ...]:
    """The ``most`` most frequent words, as bucket << 32 | rank."""

    def run(batches):
        for row in each(batches):
            names, counts = np.frombuffer(row["names"], np.int64), np.frombuffer(row["often"], np.int64)
            top = np.lexsort((names, -counts))[:most]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names[top]), pa.array(counts[top]), pa.array(top + (row["bucket"] << 32))],
                ["w", "n", "number"],
            )

    top = words_.mapInArrow(run, "w long, n long, number long").orderBy(F.desc("n"), "w").limit(most)
    return tuple(row.number for row in top.collect())


def _first_classes(shape: Shape):
    def run(batches):
        for row in each(batches):
            own = shape.start((row["bucket"] << 32) + np.arange(len(row["names"]) // 8)).tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["bucket"]], pa.int32()), pa.array([own], pa.binary())],
                ["bucket", "classes"],
            )

    return run


_LEARNED = (
    "chunk long, doc_id array<long>, held_out binary, sizes binary, places binary, counts binary, "
    "often binary, steps binary, turns binary, end_at int"
)


def _turn(names: np.ndarray) -> np.ndarray:
    """The turn of each word, by its hash."""
    return (mix(names ^ np.uint64(0xA5A5F00DCAFE5EED)) % np.uint64(TURNS)).astype(np.uint8)


def _with_counts(count: int, shape: Shape):
    """Chunks with the counts of their words; of the frequent ones, by bucket and rank, also places
    and, as ``steps``, how many each bucket has and their ranks."""

    def run(batches):
        for row in each(batches):
            names = np.frombuffer(row["names"], np.uint64)
            order = np.argsort(_bucket(names, count), kind="stable")
            counts = np.zeros(len(names), np.int64)
            answers = sorted(row["answers"], key=lambda x: x["bucket"])
            counts[order] = np.concatenate([_narrow(x["counts"]) for x in answers])
            often = np.flatnonzero((counts >= shape.frequent) & (names != _END))
            bucket = _bucket(names[often], count)
            often = often[np.lexsort((names[often], bucket))]
            many = np.bincount(bucket, minlength=count)
            steps = np.concatenate([grow(x["ranks"], 1)[0] for x in answers])
            out = [
                row["chunk"], row["doc_id"], row["held_out"], row["sizes"], row["places"],
                _wide(counts), shrink(often), shrink(many, steps), shrink(_turn(names[often])),
                int(np.flatnonzero(names == _END)[0]),
            ]
            kinds = (
                pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 7, pa.int32(),
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip(out, kinds)],
                [x.split(" ")[0] for x in _LEARNED.split(", ")],
            )

    return run


def _ask(turn: int):
    """The frequent words of each chunk that may move in a turn, dealt out."""

    def run(batches):
        for row in each(batches):
            many, steps = grow(row["steps"], 2)
            moving = grow(row["turns"], 1)[0] == turn
            edges = np.append(0, np.cumsum(many.astype(np.int64))).tolist()
            parts = []
            for b, (i, j) in enumerate(zip(edges, edges[1:])):
                if moving[i:j].any():
                    parts.append((b, shrink(_steps(_ranks(steps[i:j])[moving[i:j]]))))
            if parts:
                b, n = zip(*parts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(b, pa.int32()), pa.array([row["chunk"]] * len(b), pa.int64()),
                        pa.array(n, pa.binary()),
                    ],
                    ["bucket", "chunk", "steps"],
                )

    return run


def _answer(asked: pa.Table, known: pa.Table) -> pa.Table:
    classes = joined(known.column("classes").to_pylist(), np.uint8)
    out = [classes[_ranks(grow(x, 1)[0])].tobytes() for x in asked.column("steps").to_pylist()]
    return asked.drop(["steps"]).append_column("classes", pa.array(out, pa.binary()))


def _answers(learned: DataFrame, classed: DataFrame, turn: int) -> DataFrame:
    """The classes of each chunk's frequent words of a turn, by bucket; it lies as the chunks do."""
    asked = learned.select("chunk", "steps", "turns").mapInArrow(
        _ask(turn), "bucket int, chunk long, steps binary"
    )
    known = classed.groupBy("bucket")
    answers = asked.groupBy("bucket").cogroup(known).applyInArrow(
        _answer, "bucket int, chunk long, classes binary"
    )
    answers = answers.where("chunk is not null").groupBy("chunk").agg(
        F.collect_list(F.struct("bucket", "classes")).alias(f"answers_{turn}")
    )
    return in_place(answers, "chunk-classes")


def _with_classes(learned: DataFrame, answers: dict[int, DataFrame]) -> DataFrame:
    """Chunks with the classes of their frequent words, as far as these have had a turn."""
    for turn in sorted(answers):
        learned = learned.join(answers[turn], "chunk", "left")
    return learned


def _chunk(row: dict, shape: Shape):
    """A chunk's counts, classes, text sizes, places and held-out tokens."""
    counts = _narrow(row["counts"])
    often = grow(row["often"], 1)[0]
    many, steps = grow(row["steps"], 2)
    ranks = [_ranks(x) for x in np.split(steps, np.cumsum(many.astype(np.int64))[:-1])]
    bucket = np.repeat(np.arange(len(many)) << 32, many)
    own = shape.start(bucket + np.concatenate(ranks))
    turns = grow(row["turns"], 1)[0]
    for turn in range(TURNS):
        if row.get(f"answers_{turn}"):
            parts = sorted(row[f"answers_{turn}"], key=lambda x: x["bucket"])
            own[turns == turn] = joined([x["classes"] for x in parts], np.uint8)
    classes = shape.rare(counts)
    classes[often] = own
    classes[row["end_at"]] = shape.end
    sizes = np.frombuffer(row["sizes"], np.uint32).astype(np.int64)
    places = grow(row["places"], 1)[0]
    out = np.repeat(np.frombuffer(row["held_out"], bool), sizes)
    return counts, classes, sizes, places, out


def _before(classes: np.ndarray, sizes: np.ndarray, end: int) -> np.ndarray:
    """The class before each token."""
    before = np.empty_like(classes)
    before[1:] = classes[:-1]
    before[np.cumsum(sizes) - sizes] = end
    return before


def _bigrams(chunked: DataFrame, shape: Shape) -> np.ndarray:
    """How often each class follows each in training texts: a table of a fixed size."""
    c = shape.total

    def run(batches):
        total = np.zeros(c * c, np.int64)
        for row in each(batches):
            _, classes, sizes, places, out = _chunk(row, shape)
            own = classes[places]
            before = _before(own, sizes, shape.end)[~out].astype(np.int32)
            total += np.bincount(before * c + own[~out], minlength=c * c)
        cell = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(total[cell])], ["cell", "n"])

    counted = chunked.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    total = np.zeros(c * c, np.int64)
    for row in counted.collect():  # one for each cell
        total[row.cell] = row.n
    return total.reshape(c, c)


def likelihood(table: np.ndarray) -> float:
    """What depends on the classes of the log likelihood of the class bigrams."""
    table = table.astype(np.float64)
    return float(
        _entropy(table).sum() - _entropy(table.sum(axis=0)).sum() - _entropy(table.sum(axis=1)).sum()
    )


def _contexts(chunked: DataFrame, shape: Shape, turn: int) -> DataFrame:
    """Training counts of (frequent word, side, neighbour's class) of a turn, dealt out by word.

    ``blob`` holds the ranks of the words, how many pairs each has, and the pairs with their counts.
    """
    c = shape.total
    wide = 2 * c

    def run(batches):
        for row in each(batches):
            _, classes, sizes, places, out = _chunk(row, shape)
            often = grow(row["often"], 1)[0]
            moving = grow(row["turns"], 1)[0] == turn
            number = np.full(len(classes), -1, np.int32)
            number[often[moving]] = np.flatnonzero(moving)
            own = classes[places]
            after = np.full_like(own, shape.end)
            after[:-1] = own[1:]
            after[np.cumsum(sizes) - 1] = shape.end
            word = number[places]
            use = ~out & (word >= 0)
            first = word[use].astype(np.int64) * wide
            sides = [first + _before(own, sizes, shape.end)[use], first + c + after[use]]
            key, times = np.unique(np.concatenate(sides), return_counts=True)
            which = key // wide
            many, steps = grow(row["steps"], 2)
            edges = np.append(0, np.cumsum(many.astype(np.int64)))
            cuts = np.searchsorted(which, edges).tolist()
            parts = []
            for b, (i, j) in enumerate(zip(cuts, cuts[1:])):
                if j > i:
                    mine, pairs = np.unique(which[i:j] - edges[b], return_counts=True)
                    rank = _ranks(steps[edges[b] : edges[b + 1]])[mine]
                    parts.append((b, shrink(_steps(rank), pairs, key[i:j] % wide, times[i:j])))
            if parts:
                b, x = zip(*parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(b, pa.int32()), pa.array(x, pa.binary())], ["bucket", "blob"]
                )

    return chunked.mapInArrow(run, "bucket int, blob binary")


def _entropy(x: np.ndarray) -> np.ndarray:
    x = np.maximum(x, 0)
    return x * np.log(np.maximum(x, 1))


def exchange(context: np.ndarray, own: np.ndarray, table: np.ndarray, classes: int) -> np.ndarray:
    """The best class of each word, each judged as if it alone moved.

    ``context`` (words, 2, total) counts the classes before and after each word, ``table`` all
    class bigrams. A word is taken out of its class and put where the sum of n log n over class
    bigrams, less that over classes twice, becomes largest; of equal ones into the first. Bigrams of
    a word with itself count as any other of its class.
    """
    table = table.astype(np.float64)
    out = own.copy()
    columns, rows_ = table.sum(axis=0), table.sum(axis=1)
    left_of, right_of = np.ascontiguousarray(table[:, :classes].T), np.ascontiguousarray(table[:classes])
    plain_left, plain_right = _entropy(left_of), _entropy(right_of)
    for w in range(len(own)):
        left, right = context[w, 0], context[w, 1]
        a, use_l, use_r = int(own[w]), np.flatnonzero(context[w, 0]), np.flatnonzero(context[w, 1])
        l, r = left[use_l], right[use_r]
        # Only cells with a count of the word change.
        t = left_of[:, use_l]
        gain = (_entropy(t + l) - plain_left[:, use_l]).sum(axis=1)
        t = right_of[:, use_r]
        gain += (_entropy(t + r) - plain_right[:, use_r]).sum(axis=1)
        n_left, n_right = l.sum(), r.sum()
        gain -= _entropy(columns[:classes] + n_left) - _entropy(columns[:classes])
        gain -= _entropy(rows_[:classes] + n_right) - _entropy(rows_[:classes])
        # Its own class is judged without it.
        gain[a] = (plain_left[a, use_l] - _entropy(left_of[a, use_l] - l)).sum()
        gain[a] += (plain_right[a, use_r] - _entropy(right_of[a, use_r] - r)).sum()
        gain[a] -= _entropy(columns[a : a + 1])[0] - _entropy(columns[a : a + 1] - n_left)[0]
        gain[a] -= _entropy(rows_[a : a + 1])[0] - _entropy(rows_[a : a + 1] - n_right)[0]
        out[w] = int(gain.argmax())
    return out


def _move(table: np.ndarray, shape: Shape):
    """The frequent words of a bucket, those of the turn with new classes."""

    def run(known: pa.Table, seen: pa.Table) -> pa.Table:
        classes = joined(known.column("classes").to_pylist(), np.uint8).copy()
        wide = 2 * shape.total
        blobs = [grow(blob, 4) for blob in seen.column("blob").to_pylist()]
        at = [np.repeat(_ranks(steps), many) for steps, many, _, _ in blobs]
        words_ = np.unique(np.concatenate([np.zeros(0, np.int64), *at]))
        for first in range(0, len(words_), 1 << 13):  # dense counts of some words at a time
            mine = words_[first : first + (1 << 13)]
            context = np.zeros(len(mine) * wide)
            for rank, (_, _, pair, times) in zip(at, blobs):
                place = np.searchsorted(mine, rank)
                hit = (place < len(mine)) & (mine[np.minimum(place, len(mine) - 1)] == rank)
                context[place[hit] * wide + pair[hit]] += times[hit]  # each once in a blob
            context = context.reshape(-1, 2, shape.total)
            classes[mine] = exchange(context, classes[mine].astype(np.int64), table, shape.classes)
        return pa.table(
            {
                "bucket": known.column("bucket"),
                "classes": pa.array([classes.tobytes()] * known.num_rows, pa.binary()),
            }
        )

    return run


def _scored(chunked: DataFrame, shape: Shape, table, n: int, v: int) -> DataFrame:
    """Scores of all documents from the class bigrams."""
    smooth = table + _SMOOTH
    turn = np.log10(smooth / smooth.sum(axis=1, keepdims=True))
    total = table.sum(axis=0)
    once = shape.classes
    share, unseen = np.log10(1 - UNSEEN), np.log10(UNSEEN)

    def run(batches):
        for row in each(batches):
            counts, classes, sizes, places, _ = _chunk(row, shape)
            known = counts > 0
            emit = np.log10(np.maximum(counts, 1)) - np.log10(np.maximum(total[classes], 1))
            emit = np.where(classes == once, emit + share, emit)
            emit = np.where(known, emit, unseen)
            base = np.log10((counts + 0.5) / (n + 0.5 * (v + 1)))
            own = classes[places]
            score = turn[_before(own, sizes, shape.end), own] + emit[places]
            first = np.cumsum(sizes) - sizes
            add = lambda x: np.add.reduceat(x, first)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["doc_id"], pa.int64()),
                    pa.array(np.frombuffer(row["held_out"], bool)), pa.array(sizes),
                    pa.array(add(known[places].astype(np.int64))),
                    pa.array(np.full(len(sizes), n)), pa.array(add(base[places])),
                    pa.array(add(score)),
                ],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return chunked.mapInArrow(
        run,
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double",
    )


def score_documents(
    docs: DataFrame, held_out, classes: int = CLASSES, frequent: int = FREQUENT, rounds: int = ROUNDS
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row.

    Learns from the rows of ``docs`` where the column ``held_out`` is not true, and scores all.
    ``score`` is the log10 probability of the text under the classes, ``base_score`` under word
    counts alone. Uses doc_id and text; other columns are ignored. A null or empty text is the end
    alone. Repeated rows and null ids are rows like any other. An empty table gives no rows.
    """
    held = F.coalesce(held_out, F.lit(False)).alias("held_out")
    chunked = in_place(encoded(docs.select("doc_id", "text", held)), "encoded")
    found = chunked.agg(F.sum("n"), F.sum(F.octet_length("names")) / 8).first()
    n, count = found[0] or 0, max(128, int(found[1] or 0) // BUCKET)
    shape = Shape(classes, frequent)
    dictionaries = chunked.select("chunk", "names", "counts").mapInArrow(
        _dictionaries(count), "bucket int, chunk long, names binary, counts binary"
    )
    counted = dictionaries.groupBy("bucket").applyInArrow(
        _count(shape),
        "chunk long, bucket int, counts binary, ranks binary, names binary, often binary, v long",
    )
    counted = written(counted, "word-counts")
    v = counted.agg(F.sum("v")).first()[0] or 0
    answers = counted.where("chunk is not null").groupBy("chunk").agg(
        F.collect_list(F.struct("bucket", "counts", "ranks")).alias("answers")
    )
    learned = chunked.drop("counts", "n").join(answers, "chunk")
    learned = in_place(learned.mapInArrow(_with_counts(count, shape), _LEARNED), "learned")
    kind = "bucket int, classes binary"
    words_ = counted.where("chunk is null").select("bucket", "names", "often")
    shape = Shape(classes, frequent, _seeds(words_, classes - 1))
    classed = words_.mapInArrow(_first_classes(shape), kind)
    both, table, answers = learned, _bigrams(learned, shape), {}
    for k in range(rounds * TURNS):
        turn = k % TURNS
        contexts = _contexts(both, shape, turn).groupBy("bucket")
        moved = classed.groupBy("bucket").cogroup(contexts).applyInArrow(_move(table, shape), kind)
        moved = written(moved, f"classes-{k}")
        mine = answers | {turn: _answers(learned, moved, turn)}
        after = _with_classes(learned, mine)
        counted = _bigrams(after, shape)
        if likelihood(counted) > likelihood(table):
            classed, both, table, answers = moved, after, counted, mine
    return _scored(both, shape, table, n, v)
