"""Exact Jaccard join on word n-grams by a partitioned universe and the pigeonhole principle.

A document is its set of distinct shingles. Sets whose sizes fall into one band have their
elements dealt by hash into the same m segments. Two linked sets of a band differ in at
most H elements, so if every set puts weights 0, 1 or 2 on the segments that add up to
more than H, some segment of weight w differs in less than w elements: it is equal
(weight 1), or equal after one deletion on either side (weight 2). A set is therefore
indexed under the hash of each segment's subset, and for the double segment also under
the subset's one-deletion neighbourhood.

The weights follow cost: a segment with no or one element would meet very many sets, so
it gets weight 0 while the budget lasts. The budget comes from spare segments, which cost
one key each, and from the double segment. Keys of weight 0 still answer the keys of
other sets but ask nothing themselves.

Equal sets form one class and are joined once. Under one key only links to the first
member are tried at first (a star, not all pairs); members of a key that are not in one
component after that are compared across components in a second turn. So no link that
joins two components is lost, and a group of near copies that are linked costs as many
comparisons as it has members, not their square. Before a comparison, parity sketches of
both sets give a lower bound of their difference that rules out most unlinked pairs
safely; what remains is verified on the whole texts: one star link of each class first,
then those of the others whose ends are still apart. The second turn does likewise with
the likeliest pair of every two components, so a class on the fringe of a large group is
held against one member and not against all that it might be linked to.

Hot keys: a task sends a class's keys once, however many copies it reads; rows under one
key are streamed in sorted order and never held together; comparisons against a class
that many others meet are split by salt. In the second turn a large key's members are
dealt to blocks whose pairs are many tasks' work. It compares the sketches of a key's
members across components in numpy; that is the one step that grows with the square of a
group's fringe, by a few operations for each pair. The broadcast of candidates is bounded by
``BROADCAST_PAIRS``; beyond, the same join is shuffled.

Defined results: words are divided by white space and A-Z lower-cased; a document of
fewer words than a shingle has its whole sequence as the only shingle; one without words,
or null, has none and is linked with nothing; repeated rows are members of one class; a
missing doc_id is never a component's id unless no member has one; an empty table gives
no rows; ``near_duplicates`` looks at id and text only, ``one_of_each`` passes columns of
any names on. Sets are told apart by 64-bit hashes of shingles and of whole sets.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orgloom.llm.common import arrow_schema, as_batches, lower_words, map_batches, n_partitions, plainly_named, small, staged, table
from orgloom.llm.components import components
from orgloom.llm.hashing import WordHashes, mix, mix_int, sequence_hashes, signed

WORDS = 4
PERCENT = 85
BAND = 1.5
BROADCAST_PAIRS = 1_000_000
#: Comparisons with one class in a task, and rows of a task's output held before it is sent.
SALT = 500
#: Keys of a class by which a pair's repeated meetings are told.
FIRST = 32
#: Words of 64 bits in a set's parity sketch.
SKETCH = 16
HELD = 200_000
#: Rows of one key that a task holds; a key with more is sent in pieces under one name.
PIECE = 5 * HELD
#: Rows of a block, and about the bytes in one; rows of a cell from which shared keys are looked for.
BLOCK, BLOCK_BYTES, SHARED_ROWS = 8_000, 16_000_000, 200
#: Pairs, and words of their wide sketches, that are compared at once.
PAIRS_AT_ONCE, WORDS_AT_ONCE = 65_536, 1_000_000
#: No key without its last bit is this number.
NO_KEY = np.int64(-(1 << 63))

_U = np.uint64


class Shingles:
    """Sets of shingle hashes, sorted."""

    def __init__(self, words: int = WORDS):
        self.words, self.hashes = words, WordHashes()

    def __call__(self, text: str | None) -> np.ndarray:
        words = lower_words(text)
        if not words:
            return np.zeros(0, np.uint64)
        return np.unique(sequence_hashes(self.hashes(words), min(self.words, len(words))))


def set_id(elements: np.ndarray) -> int:
    """One number for a whole set."""
    total = int(mix(elements ^ _U(0x5E7)).sum(dtype=np.uint64))
    return int(signed(mix(np.array([total ^ (len(elements) << 1)], np.uint64)))[0])


def sketch_of(elements: np.ndarray, length: int = SKETCH) -> list[int]:
    """Parities of the numbers of elements that hash to each of ``64 * length`` places.

    The places in which two sketches differ are at most as many as the sets' differing
    elements. The two halves of a sketch, one laid on the other, are the sketch of half
    the length.
    """
    places = (mix(elements ^ _U(0x5CE7)) % _U(64 * length)).astype(np.int64)
    odd = (np.bincount(places, minlength=64 * length) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64).tolist()


def wide_sketch_of(elements: np.ndarray) -> list[int] | None:
    """For a set that is large for ``SKETCH`` words, a sketch of a length that suits it."""
    n = len(elements)
    return sketch_of(elements, 1 << math.ceil(math.log2(n / 24))) if n > 90 * SKETCH else None


def wide_differ(x: Column, y: Column) -> Column:
    """The places in which two wide sketches differ, the longer one halved if need be."""
    length = F.least(F.size(x), F.size(y))
    xor = lambda a, b: a.bitwiseXOR(b)

    def halved(s: Column) -> Column:
        half = F.zip_with(F.slice(s, 1, length), F.slice(s, length + 1, length), xor)
        return F.when(F.size(s) == length, s).otherwise(half)

    ones = F.transform(F.zip_with(halved(x), halved(y), xor), lambda w: F.bit_count(w))
    return F.aggregate(ones, F.lit(0), lambda total, n: total + n)


def may_link(a: str, b: str, percent: int) -> Column:
    """Whether sizes and sketches allow a link of two rows with n and sketch; false only if there is none."""
    na, nb = F.col(f"{a}.n").cast("long"), F.col(f"{b}.n").cast("long")
    differ = sum(
        (F.bit_count(F.col(f"{a}.sketch")[i].bitwiseXOR(F.col(f"{b}.sketch")[i])) for i in range(SKETCH)), F.lit(0)
    )
    wide = wide_differ(F.col(f"{a}.wide"), F.col(f"{b}.wide"))
    near = F.greatest(F.size(f"{a}.wide"), F.size(f"{b}.wide")) <= 2 * F.least(F.size(f"{a}.wide"), F.size(f"{b}.wide"))
    both = F.col(f"{a}.wide").isNotNull() & F.col(f"{b}.wide").isNotNull() & near
    most = (100 - percent) * (na + nb)
    return (
        (100 * F.least(na, nb) >= percent * F.greatest(na, nb))
        & ((100 + percent) * differ.cast("long") <= most)
        & (~both | ((100 + percent) * wide.cast("long") <= most))
    )


class Plan:
    """Bands, and the segments and weights in each, for a threshold in hundredths."""

    def __init__(self, percent: int = PERCENT, width: float = BAND):
        self.percent, self.width = percent, width
        self.tops = [1]

    def band(self, size: int) -> int:
        while self.tops[-1] < size:
            self.tops.append(max(self.tops[-1] + 1, int(self.tops[-1] * self.width)))
        return int(np.searchsorted(self.tops, size))

    def bottom(self, band: int) -> int:
        self.band(1 if band == 0 else self.tops[min(band, len(self.tops)) - 1] + 1)
        return 1 if band == 0 else self.tops[band - 1] + 1

    def differ(self, band: int) -> int:
        """H: how many elements linked sets of the band differ in at most.

        Linked sets have percent * union <= 100 * intersection, so of a + b elements at
        most (100 - percent) / (100 + percent) are on one side only.
        """
        self.band(self.bottom(band))
        return (100 - self.percent) * 2 * self.tops[band] // (100 + self.percent)

    @lru_cache(maxsize=None)  # noqa: B019  one plan for each task
    def segments(self, band: int) -> tuple[int, int]:
        """m and the number of spare segments among them."""
        needed = self.differ(band) + 1
        if needed == 1:
            return 1, 0
        mean = self.bottom(band) * self.percent / 100 / needed
        costly = needed * math.exp(-mean) * (1 + mean)  # segments with no or one element
        budget = math.ceil(costly + 6 * math.sqrt(costly)) + 1  # next to no set has more empty ones
        # The double segment pays for one. Spare segments make all of them smaller, so not too many.
        spare = min(budget - 1, max(1, needed // 4))
        return needed + spare, spare

    def bands(self, size: int) -> list[int]:
        """The band of a set, and the next one if the set may be linked to larger ones in it."""
        own = self.band(size)
        return [own, own + 1] if 100 * size >= self.percent * self.bottom(own + 1) else [own]


def keys_of(elements: np.ndarray, plan: Plan) -> tuple[np.ndarray, np.ndarray]:
    """Index keys of a set and, for each, whether it is weak: it answers but doesn't ask."""
    keys, weak = [], []
    for band in plan.bands(len(elements)):
        m, spare = plan.segments(band)
        seed = _U(mix_int(band + 0xBA2D))
        place = (mix(elements ^ seed) % _U(m)).astype(np.int64)
        value = mix(elements + seed)
        order = np.argsort(place, kind="stable")
        counts = np.bincount(place, minlength=m)
        full = counts > 0
        sums = np.zeros(m, np.uint64)
        starts = np.concatenate([[0], np.cumsum(counts[full])[:-1]])
        sums[full] = np.add.reduceat(value[order], starts)
        salt = mix(np.arange(m, dtype=np.uint64) ^ seed)
        key = mix((sums ^ salt) + counts.astype(np.uint64))
        asks_not = np.zeros(m, bool)
        double = m > 1 and counts[0] >= 2
        costly = np.flatnonzero(counts <= 1)
        skipped = costly[np.argsort(counts[costly], kind="stable")][: spare + double]
        if double or spare:
            asks_not[skipped] = True
        keys.append(key)
        weak.append(asks_not)
        if m > 1 and counts[0]:
            inside = value[place == 0]
            keys.append(mix(((sums[0] - inside) ^ salt[0]) + _U(counts[0] - 1)))
            weak.append(np.full(len(inside), not (double and len(skipped) > spare)))
    return np.concatenate(keys), np.concatenate(weak)


#: What an index row holds besides its key.
ENTRY = np.dtype([("sid", "<i8"), ("n", "<i4")])


def entries(payload: pa.Array) -> np.ndarray:
    """The ``ENTRY`` of each row, without a copy."""
    if not len(payload):
        return np.zeros(0, ENTRY)
    _, offsets, data = payload.buffers()
    first = np.frombuffer(offsets, np.int32)[payload.offset]
    return np.frombuffer(data, ENTRY, len(payload), int(first))


def index_rows(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Index rows (payload: an ``ENTRY``) and membership rows (key of their own, payload: longer).

    The last bit of an index row's key says whether it is weak, so that one column gives
    the order. Two plain columns, because each column costs time for each of many rows
    on their way to Python. A set's sketches come with its first membership row in a task.
    """
    schema = StructType.fromDDL("key long, payload binary")
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, plan, sent = Shingles(words), Plan(percent), set()
        for batch in batches:
            ids, members, sketches, wide, key, sid, size, weak = [], [], [], [], [], [], [], []
            rows = 0
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                elements = shingles(text)
                n = len(elements)
                of = set_id(elements) if n else None
                ids.append(doc_id)
                members.append((of, n))
                new = n > 0 and of not in sent
                sketches.append(sketch_of(elements) if new else None)
                wide.append(wide_sketch_of(elements) if new else None)
                if not n or of in sent:
                    continue
                sent.add(of)
                k, w = keys_of(elements, plan)
                key.append(k)
                weak.append(w)
                sid.append(np.full(len(k), of, np.int64))
                size.append(np.full(len(k), n, np.int32))
                rows += len(k)
                if rows > HELD:
                    yield from index_batch(key, sid, size, weak)
                    key, sid, size, weak, rows = [], [], [], [], 0
            if rows:
                yield from index_batch(key, sid, size, weak)
            said = zip(ids, members, sketches, wide, strict=True)
            yield from as_batches(
                {
                    "key": [mix_int(i or 0) - (1 << 63) for i in ids],
                    "payload": [pickle.dumps((i, of, n, a, b)) for i, (of, n), a, b in said],
                },
                arrow,
            )

    def index_batch(key, sid, size, weak) -> Iterator[pa.RecordBatch]:
        keys = signed((np.concatenate(key) & ~_U(1)) | np.concatenate(weak).astype(np.uint64))
        held = np.empty(len(keys), ENTRY)
        held["sid"], held["n"] = np.concatenate(sid), np.concatenate(size)
        fixed = pa.Array.from_buffers(pa.binary(ENTRY.itemsize), len(keys), [None, pa.py_buffer(held.tobytes())])
        yield from as_batches({"key": pa.array(keys), "payload": fixed.cast(pa.binary())}, arrow)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


#: Kinds of rows that a key's members give.
MEMBER, EDGE, BUCKET = 0, 1, 2


def candidates(index: DataFrame, percent: int = PERCENT, piece: int = PIECE) -> DataFrame:
    """kind, a, b, n, weak, sketch: members (doc_id, sid, n, sketch), star edges (hub, sid) and buckets (bucket, sid, n, weak)."""
    schema = StructType.fromDDL("kind int, a long, b long, n int, weak boolean, sketch array<long>, wide array<long>")
    arrow = arrow_schema(schema)

    def rows(kind, a, b, n, weak, sketch=None, wide=None) -> Iterator[pa.RecordBatch]:
        columns = {"kind": pa.array(np.full(len(a), kind, np.int32)), "a": a, "b": b, "n": n, "weak": weak}
        none = pa.nulls(len(a), pa.list_(pa.int64()))
        sketches = {"sketch": none if sketch is None else sketch, "wide": none if wide is None else wide}
        yield from as_batches(columns | sketches, arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        types = [arrow.field(c).type for c in ("a", "b", "n", "sketch", "wide")]
        rest = None  # rows of the key at which the last batch ended
        cut = NO_KEY  # a very large key that is sent piece by piece
        for batch in batches:
            is_member = pa.compute.greater(pa.compute.binary_length(batch["payload"]), ENTRY.itemsize)
            members = batch["payload"].filter(is_member).to_pylist()
            if members:
                said = zip(*map(pickle.loads, members), strict=True)
                doc_id, of, n, sketch, wide = (pa.array(x, t) for x, t in zip(said, types, strict=True))
                yield from rows(MEMBER, doc_id, of, n, pa.nulls(len(n), pa.bool_()), sketch, wide)
            index = batch.filter(pa.compute.invert(is_member))
            held = entries(index["payload"])
            now = [index["key"].to_numpy(), held["sid"], held["n"]]
            if rest is not None:
                now = [np.concatenate(x) for x in zip(rest, now, strict=True)]
            if not len(now[0]):
                continue
            last = np.searchsorted(now[0], now[0][-1] & ~1)  # where the last key begins
            if len(now[0]) - last > piece:  # send what there is, keep the key's first row, which asks if any does
                yield from buckets(*[x[:last] for x in now], seen, cut)
                cut = now[0][-1] >> 1
                yield from buckets(*[x[last:] for x in now], seen, cut)
                rest = [x[last : last + 1] for x in now]
                continue
            yield from buckets(*[x[:last] for x in now], seen, cut)
            rest = [x[last:] for x in now]
        if rest is not None:
            yield from buckets(*rest, seen, cut)

    def buckets(packed, sid, n, seen, cut) -> Iterator[pa.RecordBatch]:
        key = packed >> 1
        same = key[1:] == key[:-1]
        met = np.append(same, False) | np.append(False, same)  # most keys have one row
        if not met.any():
            return
        order = np.flatnonzero(met)
        order = order[np.lexsort((sid[order], packed[order]))]  # rows that ask first
        key, sid, n, weak = key[order], sid[order], n[order], (packed[order] & 1).astype(bool)
        fresh = np.concatenate([[True], (key[1:] != key[:-1]) | (sid[1:] != sid[:-1])])
        key, sid, n, weak = key[fresh], sid[fresh], n[fresh], weak[fresh]
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        sizes = np.diff(np.append(starts, len(key)))
        asks = ~weak[starts] & (sizes > 1)
        if not asks.any():
            return
        run_of = np.repeat(np.arange(len(starts)), sizes)
        used = asks[run_of]
        hub = starts[run_of]
        a, b, na, nb = sid[hub[used]], sid[used], n[hub[used]].astype(np.int64), n[used].astype(np.int64)
        fits = (a != b) & (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb))
        if fits.any():
            pairs = np.unique(np.stack([a[fits], b[fits]]), axis=1)
            none = pa.nulls(pairs.shape[1], pa.int32())
            yield from rows(EDGE, pa.array(pairs[0].copy()), pa.array(pairs[1].copy()), none, pa.nulls(len(none), pa.bool_()))
        # Members of keys with three or more; keys with the same members count once.
        pieces = asks & (key[starts] == cut)
        many = (asks & (sizes > 2)) | pieces
        if not many.any():
            return
        names = signed(np.add.reduceat(mix(sid.view(np.uint64) ^ _U(0xB0C)) ^ weak.astype(np.uint64), starts))
        new = pieces.copy()
        for i in np.flatnonzero(many & ~pieces):
            if names[i] not in seen:
                seen.add(names[i])
                new[i] = True
        if len(seen) > 5 * HELD:
            seen.clear()
        names[pieces] = cut  # all pieces of a key have one name
        at = new[run_of]
        if at.any():
            yield from rows(BUCKET, pa.array(names[run_of[at]]), pa.array(sid[at]), pa.array(n[at]), pa.array(weak[at]))

    dealt = index.repartition(n_partitions(index), F.shiftright("key", 1))
    return dealt.sortWithinPartitions("key").mapInArrow(run, schema)


class Outlines:
    """What tells of some sets whether they may be linked: sizes, sketches and wide sketches by length."""

    def __init__(self, batch: pa.RecordBatch):
        self.n = batch["n"].to_numpy().astype(np.int64)
        self.sketch = batch["sketch"].flatten().to_numpy().reshape(-1, SKETCH).view(np.uint64)
        self.length = batch["wide"].value_lengths().fill_null(0).to_numpy().astype(np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.wide = batch["wide"].flatten().to_numpy().view(np.uint64)

    def near(self, i: np.ndarray, j: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Which of the pairs ``may_link``, and for these the places in which their sketches differ."""
        least, most = np.minimum(self.n[i], self.n[j]), np.maximum(self.n[i], self.n[j])
        kept = np.flatnonzero(100 * least >= percent * most)
        differ = np.bitwise_count(self.sketch[i[kept]] ^ self.sketch[j[kept]]).sum(axis=1, dtype=np.int64)
        bound = (100 - percent) * (least + most)[kept]
        fits = (100 + percent) * differ <= bound
        kept, differ, bound = kept[fits], differ[fits], bound[fits]
        x, y = self.length[i[kept]], self.length[j[kept]]
        fits = np.ones(len(kept), bool)
        for a, b in {*zip(x.tolist(), y.tolist(), strict=True)}:
            if min(a, b) and max(a, b) <= 2 * min(a, b):
                of = np.flatnonzero((x == a) & (y == b))
                for part in np.array_split(of, math.ceil(len(of) * max(a, b) / WORDS_AT_ONCE)):
                    places = self._wide_differ(i[kept[part]], a, j[kept[part]], b)
                    fits[part] = (100 + percent) * places <= bound[part]
        return kept[fits], differ[fits]

    def _wide_differ(self, i: np.ndarray, a: int, j: np.ndarray, b: int) -> np.ndarray:
        length = min(a, b)

        def halved(rows: np.ndarray, of: int) -> np.ndarray:
            words = self.wide[self.start[rows][:, None] + np.arange(of)]
            return words if of == length else words[:, :length] ^ words[:, length:]

        return np.bitwise_count(halved(i, a) ^ halved(j, b)).sum(axis=1, dtype=np.int64)


def block_counts(block: int = BLOCK) -> list[Column]:
    """Into how many blocks the asking rows of a bucket and all its rows are dealt."""

    def blocks(weight: Column) -> Column:
        rows, size = F.sum(weight), F.sum(weight * (F.col("n") + 512))
        return F.greatest(F.ceil(rows / block), F.ceil(size / BLOCK_BYTES), F.lit(1)).cast("int")

    return [blocks((~F.col("weak")).cast("long")).alias("p_of"), blocks(F.lit(1).cast("long")).alias("q_of")]


def across(rows: DataFrame, percent: int = PERCENT) -> DataFrame:
    """a, b, ra, rb, d: pairs in one bucket but two components of which one asks and that ``may_link``.

    a < b, with their components and the places in which the sketches differ. A pair that
    meets in several buckets may come several times. Of a bucket's blocks each of asking
    rows meets each of all rows in a cell of its own, so a large bucket is many tasks'
    work; a cell's pairs are compared in numpy, some at a time. Keys that a pair also
    shares and that count before are known for the commonest 64 in a cell.
    """
    schema = StructType.fromDDL("a long, b long, ra long, rb long, d int")
    arrow = arrow_schema(schema)
    own = {c: F.pmod(F.xxhash64("sid", F.lit(c)), F.col(f"{c}_of")).cast("int") for c in "pq"}
    asks, yes, no = ~F.col("weak"), F.lit(True), F.lit(False)

    def cell(p: Column, q: Column, asker: Column, member: Column) -> Column:
        return F.struct(p.alias("p"), q.alias("q"), asker.alias("asker"), member.alias("member"))

    as_asker = F.transform(F.sequence(F.lit(0), F.col("q_of") - 1), lambda q: cell(own["p"], q, yes, q == own["q"]))
    as_member = F.transform(F.sequence(F.lit(0), F.col("p_of") - 1), lambda p: cell(p, own["q"], no, yes))
    elsewhere = F.filter(as_member, lambda c: c["p"] != own["p"])
    cells = F.when(asks, F.concat(as_asker, elsewhere)).otherwise(as_member)
    spread = rows.withColumn("cell", F.explode(cells)).select("bucket", "cell.*", "weak", "sid", "root", "n", "sketch", "wide", "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None  # rows of the cell at which the last batch ended
        for batch in batches:
            held = batch if rest is None else pa.concat_batches([rest, batch])
            if not held.num_rows:
                continue
            names = np.stack([held[c].to_numpy() for c in ("bucket", "p", "q")])
            starts = np.flatnonzero(np.append(True, (names[:, 1:] != names[:, :-1]).any(axis=0)))
            yield from compared(held.slice(0, starts[-1]), starts)
            rest = held.slice(starts[-1])
        if rest is not None:
            yield from compared(rest, np.array([0, rest.num_rows]))

    def compared(held: pa.RecordBatch, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        """The pairs of whole cells, which begin at ``starts``; the last of these is the end."""
        if not held.num_rows:
            return
        outlines, found = Outlines(held), []
        sid, root, bucket = (held[c].to_numpy() for c in ("sid", "root", "bucket"))
        asker, member = (held[c].to_numpy(zero_copy_only=False) for c in ("asker", "member"))
        for start, end in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            before = np.zeros(0, np.uint64)
            if end - start >= SHARED_ROWS:
                before = smaller_keys(held["first"].slice(start, end - start), bucket[start])
            # Rows are in order of weakness and sid: what comes after an asking row has not asked it.
            i, j = start + np.flatnonzero(asker[start:end]), start + np.flatnonzero(member[start:end])
            first = np.searchsorted(j, i, "right")
            counts = len(j) - first
            total = np.cumsum(counts)
            at = 0
            while at < len(i):
                done = total[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(total, done + PAIRS_AT_ONCE, "right")))
                n = counts[at:to]
                x = np.repeat(i[at:to], n)
                y = j[np.arange(len(x)) + np.repeat(first[at:to] - (total[at:to] - n - done), n)]
                apart = root[x] != root[y]
                if len(before):
                    apart &= (before[x - start] & before[y - start]) == 0
                x, y = x[apart], y[apart]
                kept, differ = outlines.near(x, y, percent)
                if len(kept):
                    found.append(np.stack([x[kept], y[kept], differ]))
                at = to
        if found:
            x, y, differ = np.concatenate(found, axis=1)
            swap = sid[x] > sid[y]
            x, y = np.where(swap, y, x), np.where(swap, x, y)
            columns = {"a": sid[x], "b": sid[y], "ra": root[x], "rb": root[y], "d": differ.astype(np.int32)}
            yield from as_batches({c: pa.array(v) for c, v in columns.items()}, arrow)

    key = ["bucket", "p", "q"]
    dealt = spread.repartition(n_partitions(rows), *key).sortWithinPartitions(*key, "weak", "sid")
    return dealt.mapInArrow(run, schema)


def smaller_keys(first: pa.ListArray, bucket: int) -> np.ndarray:
    """For each row a bit for each of the commonest 64 keys below ``bucket`` that it asks."""
    row = np.repeat(np.arange(len(first)), first.value_lengths().to_numpy())
    keys = first.flatten().to_numpy()
    row, keys = row[keys < bucket], keys[keys < bucket]
    _, which, counts = np.unique(keys, return_inverse=True, return_counts=True)
    place = np.full(len(counts), 64)
    common = np.argsort(-counts, kind="stable")[:64]
    place[common] = np.arange(len(common))
    told = place[which] < 64
    bits = np.zeros(len(first), np.uint64)
    np.bitwise_or.at(bits, row[told], _U(1) << place[which[told]].astype(np.uint64))
    return bits


def verified(docs: DataFrame, pairs: DataFrame, classes: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) of classes that are linked; each class's smallest document stands for it.

    ``pairs`` are distinct. The texts of the classes that occur travel to the partitions
    of a, one row for each comparison, and a's own text to each part of its comparisons.
    """
    degrees = pairs.groupBy("a").agg(F.count("*").alias("d"))
    parts = degrees.withColumn("parts", F.ceil(F.col("d") / SALT).cast("int"))
    asked = pairs.join(parts, "a").select(
        F.col("b").alias("sid"), "a", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("role")
    )
    hubs = parts.select(
        F.col("a").alias("sid"), "a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("role")
    )
    routes = staged(asked.unionByName(hubs).join(classes.select("sid", F.col("doc_id").alias("rep")), "sid"), "routes")
    few = routes.count() <= BROADCAST_PAIRS
    texts = docs.select(F.col("doc_id").cast("long"), "text")

    def make():
        shingles = Shingles(words)

        def run(batch: pa.RecordBatch) -> dict:
            ids = []
            for text in batch["text"].to_pylist():
                elements = shingles(text)
                ids.append(set_id(elements) if len(elements) else None)
            return {"is_doc": batch["doc_id"], "is_sid": ids, "text": batch["text"]}

        return run

    if few:  # only documents that stand for a class of some pair
        reps = routes.select(F.col("rep").alias("rep_doc")).distinct()
        texts = texts.join(F.broadcast(reps), F.col("doc_id").eqNullSafe(F.col("rep_doc")), "left_semi")
    named = map_batches(texts, make, "is_doc long, is_sid long, text string")
    joined = named.join(
        F.broadcast(routes) if few else routes,
        (F.col("is_sid") == F.col("sid")) & F.col("is_doc").eqNullSafe(F.col("rep")),
    ).select("a", "part", "role", "sid", "text")
    schema = StructType.fromDDL("a long, b long")
    arrow = arrow_schema(schema)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, at, hub = Shingles(words), None, None
        for batch in batches:
            found = []
            columns = [batch[c].to_pylist() for c in ("a", "part", "role", "sid", "text")]
            for a, part, role, sid, text in zip(*columns, strict=True):
                if not role:
                    if (a, part) != at:
                        at, hub = (a, part), shingles(text)
                    continue
                own = shingles(text)
                common = len(np.intersect1d(hub, own, assume_unique=True))
                if 100 * common >= percent * (len(hub) + len(own) - common):
                    found.append((a, sid))
            if found:
                yield from as_batches({"a": [x for x, _ in found], "b": [y for _, y in found]}, arrow)

    dealt = joined.repartition(n_partitions(docs), "a", "part").sortWithinPartitions("a", "part", "role", "sid")
    return staged(dealt.mapInArrow(compare, schema).distinct(), "links")


def classes_and_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(doc_id, sid, n) of each document; (sid, root, least) of each class of several rows or with links.

    ``least`` is the smallest doc_id of the class's component, whose name is ``root``.
    """
    found = staged(candidates(index_rows(docs, words, percent), percent), "candidates")
    made = found.filter(F.col("kind") == MEMBER).select(F.col("a").alias("doc_id"), F.col("b").alias("sid"), "n", "sketch", "wide")
    members = made.select("doc_id", "sid", "n")
    classes = made.filter("sid is not null").groupBy("sid")
    classes = staged(classes.agg(*(F.min(c).alias(c) for c in ("doc_id", "n", "sketch", "wide")), F.count("*").alias("rows")), "classes")
    stars = staged(found.filter(F.col("kind") == EDGE).select("a", "b").distinct(), "stars")
    outlines = classes.select("sid", "n", "sketch", "wide")
    likely = staged(
        stars.join(outlines.alias("x"), F.col("a") == F.col("x.sid"))
        .join(outlines.alias("y"), F.col("b") == F.col("y.sid"))
        .filter(may_link("x", "y", percent))
        .select("a", "b"),
        "likely",
    )
    # One hub for each class first: that holds most groups together, and what is together needs no more links.
    first = likely.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    links = verified(docs, staged(first, "first"), classes, words, percent)
    roots = components(links)
    rest = _apart(likely.join(first, ["a", "b"], "left_anti"), roots)
    if not rest.isEmpty():
        links = links.unionByName(verified(docs, rest, classes, words, percent))
        roots = components(links)
    # Keys whose members are not all in one component: the pairs across components remain.
    rows = found.filter(F.col("kind") == BUCKET).select(F.col("a").alias("bucket"), F.col("b").alias("sid"), "n", "weak")
    rows = rows.dropDuplicates(["bucket", "sid"])
    placed = rows.join(small(roots.withColumnRenamed("node", "sid")), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    ends = placed.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high"), *block_counts()).filter("low != high")
    still = staged(placed.drop("n").join(ends.drop("low", "high"), "bucket"), "mixed")
    # A pair counts under the smallest of its common keys, as far as the first few of each tell.
    asking = still.filter("not weak").groupBy("sid").agg(F.slice(F.array_sort(F.collect_list("bucket")), 1, FIRST).alias("first"))
    none = F.array().cast("array<long>")
    open_rows = still.join(outlines, "sid").join(asking, "sid", "left").withColumn("first", F.coalesce("first", none))
    met = across(open_rows, percent).distinct()
    # Star pairs that are still apart have been tried.
    tried = likely.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    remaining = staged(met.join(tried, ["a", "b"], "left_anti"), "across")
    if not remaining.isEmpty():
        # The likeliest pair of any two components first: most of the others are in one component after that.
        two = remaining.groupBy(F.least("ra", "rb").alias("x"), F.greatest("ra", "rb").alias("y"))
        nearest = staged(two.agg(F.min(F.struct("d", "a", "b")).alias("m")).select("m.a", "m.b"), "nearest")
        links = links.unionByName(verified(docs, nearest, classes, words, percent))
        roots = components(links)
        rest = _apart(remaining.select("a", "b").join(nearest, ["a", "b"], "left_anti"), roots)
        if not rest.isEmpty():
            more = verified(docs, rest, classes, words, percent)
            if not more.isEmpty():
                roots = components(links.unionByName(more))
    return members, _groups(classes, roots)


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes that are not yet in one component."""
    known = small(roots)
    ends = [known.select(F.col("node").alias(n), F.col("root").alias(r)) for n, r in (("a", "ra"), ("b", "rb"))]
    placed = pairs.join(ends[0], "a", "left").join(ends[1], "b", "left")
    return staged(placed.filter(F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b"), "apart")


def _groups(classes: DataFrame, roots: DataFrame) -> DataFrame:
    """sid, root and least of the classes that have several rows or links, all on the level of classes."""
    linked = classes.select("sid", "doc_id", "rows").join(small(roots.withColumnRenamed("node", "sid")), "sid", "left")
    shared = staged(linked.filter("rows > 1 or root is not null"), "shared")
    least = shared.filter("root is not null").groupBy("root").agg(F.min("doc_id").alias("least"))
    named = shared.join(small(staged(least, "least")), "root", "left")
    return staged(named.select("sid", F.coalesce("root", "sid").alias("root"), F.coalesce("least", "doc_id").alias("least")), "groups")


def with_set_id(docs: DataFrame, words: int = WORDS, name: str = "_set") -> DataFrame:
    """docs with the number of each row's set, null if that is empty, as column ``name``."""
    names = docs.columns

    def make():
        shingles = Shingles(words)

        def run(batch: pa.RecordBatch) -> dict:
            sets = map(shingles, batch["text"].to_pylist())
            return {c: batch[c] for c in names} | {name: [set_id(x) if len(x) else None for x in sets]}

        return run

    return map_batches(docs, make, docs.withColumn(name, F.lit(None).cast("long")).schema)


def one_of_each(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """docs without all but one row of each component, that of the smallest doc_id.

    Rows without words stay. Only ids that several rows have need a look at the rows'
    sets. Columns of ``docs`` may have any names.
    """
    plain = plainly_named(docs, "doc_id", "text")
    return _one_of_each(plain, words, percent).toDF(*docs.columns)


def _one_of_each(docs: DataFrame, words: int, percent: int) -> DataFrame:
    members, groups = classes_and_components(docs, words, percent)
    named = staged(members.join(small(groups), "sid"), "grouped")
    ids = docs.select(F.col("doc_id").alias("_many")).groupBy("_many").agg(F.count("*").alias("_n"))
    several = staged(ids.filter("_n > 1").select("_many"), "several")
    gone = staged(named.filter(~F.col("doc_id").eqNullSafe(F.col("least"))).select(F.col("doc_id").alias("_gone")).distinct(), "gone")
    is_gone = F.col("doc_id").eqNullSafe(F.col("_gone"))  # a single row may lack its id
    if several.isEmpty():
        return docs.join(small(gone), is_gone, "left_anti")
    is_many = F.col("doc_id").eqNullSafe(F.col("_many"))
    single = docs.join(small(several), is_many, "left_anti")
    single = single.join(small(gone), is_gone, "left_anti")
    multiple = with_set_id(docs.join(small(several), is_many, "left_semi"), words)
    grouped = small(groups.select(F.col("sid").alias("_of"), F.col("root").alias("_root"), F.col("least").alias("_least")))
    placed = multiple.join(grouped, F.col("_set") == F.col("_of"), "left")
    # Of a group's rows that have its smallest id, one stays; rows of no group are alone with their set.
    alone = placed.filter("_of is null")
    first = F.row_number().over(Window.partitionBy("_root").orderBy("_set", F.xxhash64("text")))
    chosen = placed.filter("_of is not null").filter(F.col("doc_id").eqNullSafe(F.col("_least")))
    chosen = chosen.withColumn("_place", first).filter("_place = 1")
    return single.unionByName(chosen.select(*docs.columns)).unionByName(alone.select(*docs.columns))


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id, one row for each row of ``docs``."""
    members, groups = classes_and_components(docs, words, percent)
    return members.join(small(groups.select("sid", "least")), "sid", "left").select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        F.coalesce("least", "doc_id").alias("component_id"),
    )


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
