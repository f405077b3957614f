"""N-gram Jaccard join with parity sketches.

A document's set is its distinct word shingles.  Shingles are XOR-hashed into a
bit sketch: each flips one bit, so two sketches differ in at most as many bits
as the sets' symmetric difference has members.  For a size band, the similarity
asked for bounds that difference by some k; the sketch is cut into more than k
chunks, so linked documents agree in a whole chunk (pigeonhole), and documents
are joined on the digests of their chunks.

What is joined are sets, not documents: a set is named by its size and 128 bits of
hashes of its shingles, so documents with equal sets are one node from the start,
and only the document with the smallest id stands for them when texts are compared.

A few extra chunks let empty ones, which unlike sets share, be left out
without losing a pair.  Of the sets that share a chunk the smallest is
the leader.  A set is compared to its smallest leader first; only where
that leaves several components are a leader and its members compared with each
other, in blocks.  Either time whole sketches are compared before texts are
sent: their Hamming distance is a lower bound of the symmetric difference, so
only texts with a partner within the bound go on.  Every link is verified on the
whole shingle sets (of 64-bit hashes); of the links of a block, those that join
what others already join are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skymetrics.llm import exchange
from skymetrics.llm.components import components
from skymetrics.llm.exchange import FLUSH, ROW, ROW_NAMES, ROW_STRUCT, copy_rows, original_id, row_array, unpacked
from skymetrics.llm.staging import TEXT_ROWS, stage
from skymetrics.llm.text import LOWER, SPACES, U64, Words, distinct, give_back, mix, shingles, slices

WIDTH, PERCENT = 5, 80
#: size bands grow by this factor; a sketch has this many bits per chunk
BAND_GROWTH, CHUNK_BITS = 1.3, 1 << 40
#: chunks beyond k + 1 (some, and one for so many), so that up to as many empty chunks can be left out
EXTRA, EXTRA_PER = 2, 16
#: documents of a task that share a chunk are folded to their leader before the shuffle if they are more than this
FOLD = 32
#: texts that are compared with each other at once
BLOCK = 1024

#: a set: the order is by hash, so that leaders are the same ones in every chunk and no size of them is preferred
NODE = [("first", "<i8"), ("second", "<i8"), ("n", "<i8")]
NODE_NAMES = [name for name, _ in NODE]
NODE_STRUCT = "struct<first:long,second:long,n:long>"
KEY = [("key", "<u8"), *NODE]
OWNER = [*ROW, *NODE]
PAIR = [*NODE, *((f"other_{name}", kind) for name, kind in NODE)]
KEYS, OWNERS, PAIRS, MET, SKETCHES = range(5)
FOUND_SCHEMA = f"kind int, row {ROW_STRUCT}, a {NODE_STRUCT}, b {NODE_STRUCT}, sketch binary"
#: a key that more than one in so many rows have is joined by broadcast: there are fewer such keys than this
HEAD = 1024
#: 64-bit words of the filter that texts pass before they are sent: at most so many rows are broadcast, whatever the input
FILTER_WORDS = 1 << 20


def bands(longest: int) -> np.ndarray:
    """Largest set size of each band."""
    out = [1]
    while out[-1] < longest:
        out.append(max(out[-1] + 1, int(np.ceil(out[-1] * BAND_GROWTH))))
    return np.array(out)


def chunk_keys(keys: np.ndarray, owner: np.ndarray, sizes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(digest, owner) of the sketch chunks of each set, in each band where it can meet a partner."""
    longest = max(1, 100 * int(sizes.max(initial=1)) // percent)  # of a partner
    edges = bands(int(bands(longest)[-1]) + 1)  # one band further: bounds do not depend on the sets given together
    home = np.searchsorted(edges, sizes)
    out = []
    for up in range(len(edges)):  # a set can have partners in its own band, or be the smaller one in those above
        band = np.minimum(home + up, len(edges) - 1)
        who = sizes > 0
        if up:
            who &= 100 * sizes >= percent * (edges[band - 1] + 1)
            if not who.any():
                break
        bound = edges[band]
        most = 2 * bound * (100 - percent) // (100 + percent)  # symmetric difference
        extra = EXTRA + most // EXTRA_PER
        chunks = np.where(who, np.where(most > 0, most + 1 + extra, 1), 0)
        base = np.cumsum(chunks) - chunks
        mine = who[owner]
        x, o = keys[mine], owner[mine]
        n = chunks[o].astype(U64)
        chunk = base[o] + ((x >> U64(24)) % n).astype(np.int64)
        bit = mix((x & U64(CHUNK_BITS - 1)) + U64(1))  # a random number per bit: the XOR of set bits is the digest
        total = int(chunks.sum())
        digest = np.zeros(total, U64)
        np.bitwise_xor.at(digest, chunk, bit)
        empty = np.bincount(chunk, minlength=total) == 0
        of = np.repeat(np.arange(len(sizes)), chunks)
        few = np.bincount(of, empty, len(sizes)) <= extra
        kept = ~(empty & few[of])
        place = (np.arange(total) - base[of]).astype(U64)
        digest = mix(digest ^ mix(place + (band[of].astype(U64) << U64(40)) + U64(1)))
        out.append((digest[kept], of[kept]))
    return np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out])


def _sets(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    words = Words(LOWER[data], offsets, SPACES)
    return distinct(*shingles(words, words.hashes(), width))


def _structs(records: np.ndarray, names: list[str], prefix: str = "") -> pa.StructArray:
    return pa.StructArray.from_arrays([pa.array(records[prefix + name]) for name in names], names)


def _same(records: np.ndarray, names: list[str]) -> np.ndarray:
    """Whether each record but the first equals the one before it in ``names``."""
    return np.logical_and.reduce([records[name][1:] == records[name][:-1] for name in names])


def _each_once(records: np.ndarray, names: list[str]) -> np.ndarray:
    """``records`` in the order of ``names``, of those equal in them one."""
    if not len(records):
        return records
    records = records[np.lexsort([records[name] for name in reversed(names)])]
    return records[np.concatenate([[True], ~_same(records, names)])]


def _pairs(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """PAIR records of sets and others."""
    out = np.zeros(len(two), PAIR)
    for name in NODE_NAMES:
        out[name], out[f"other_{name}"] = one[name], two[name]
    return out


def _leaders(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(smallest set of each chunk, PAIR records of it and the others) of KEY records as ``_each_once`` gives them."""
    if not len(keys):
        return keys, np.zeros(0, PAIR)
    new = np.concatenate([[True], keys["key"][1:] != keys["key"][:-1]])
    leader = keys[np.flatnonzero(new)[np.cumsum(new) - 1]]
    return keys[new], _each_once(_pairs(leader[~new], keys[~new]), [name for name, _ in PAIR])


class _Sender:
    """Gathers what a task finds out of its texts; equal sets of a flush are sent once."""

    def __init__(self, n_parts: int):
        self.n_parts, self.held, self.sketches, self.size = n_parts, [[], []], {}, 0

    def add(self, keys: np.ndarray, owners: np.ndarray, sketches: list[bytes]) -> Iterator[pa.RecordBatch]:
        for held, new in zip(self.held, (keys, owners), strict=True):
            held.append(new)
        for node, sketch in zip(owners[NODE_NAMES].tolist(), sketches, strict=True):
            if node[-1]:
                self.sketches[node] = sketch
        self.size += len(keys) + len(owners)
        if self.size >= FLUSH:
            yield from self.send()

    def send(self) -> Iterator[pa.RecordBatch]:
        if not self.held[0]:
            return
        keys, owners = (np.concatenate(x) for x in self.held)
        sketches, self.held, self.sketches, self.size = self.sketches, [[], []], {}, 0
        keys = _each_once(keys, ["key", *NODE_NAMES])
        _, place, count = np.unique(keys["key"], return_inverse=True, return_counts=True)
        many = count[place] > FOLD
        folded, pairs = _leaders(keys[many])
        keys = np.concatenate([keys[~many], folded])
        keys = keys[np.lexsort((keys["second"], keys["first"]))]
        yield from exchange.rows((keys["key"] >> U64(33)).astype(np.int64) % self.n_parts, keys, self.n_parts, KEYS)
        yield from exchange.rows(owners["hash"] % self.n_parts, owners, self.n_parts, OWNERS)
        yield from exchange.rows(pairs["first"] % self.n_parts, pairs, self.n_parts, PAIRS)
        if sketches:
            nodes = np.array(list(sketches), NODE)
            data = [node.tobytes() + sketch for node, sketch in zip(nodes, sketches.values(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes["first"] % self.n_parts, pa.int32()), pa.array(np.full(len(data), SKETCHES), pa.int32()), pa.array(data, pa.binary())],
                ["part", "kind", "records"])


def _found(kind: int, n: int, **columns: pa.Array) -> pa.Table:
    return pa.table([pa.array(np.full(n, kind), pa.int32()), *(columns.get(name, pa.nulls(n)) for name in ("row", "a", "b", "sketch"))],
                    ["kind", "row", "a", "b", "sketch"])


def _meet(table: pa.Table) -> pa.Table:
    """Of a part's records: the set of each row, pairs of sets that share a chunk (within a task, or met here), the sketch of each set."""
    owners = unpacked(table, OWNERS, OWNER)
    out = [_found(OWNERS, len(owners), row=_structs(owners, ROW_NAMES), a=_structs(owners, NODE_NAMES))]
    met = _leaders(_each_once(unpacked(table, KEYS, KEY), ["key", *NODE_NAMES]))[1]
    for kind, pairs in ((PAIRS, unpacked(table, PAIRS, PAIR)), (MET, met)):
        out.append(_found(kind, len(pairs), a=_structs(pairs, NODE_NAMES), b=_structs(pairs, NODE_NAMES, "other_")))
    head = np.dtype(NODE).itemsize
    sketches = {x[:head]: x[head:] for x in table.column("records").filter(pc.equal(table.column("kind"), SKETCHES)).to_pylist()}
    nodes = np.frombuffer(b"".join(sketches), np.dtype(NODE))
    out.append(_found(SKETCHES, len(nodes), a=_structs(nodes, NODE_NAMES), sketch=pa.array(list(sketches.values()), pa.binary())))
    return pa.concat_tables(out, promote_options="permissive")


def _bit_sketches(keys: np.ndarray, owner: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """The parity sketch of each set: as many bits as members, up to the next power of two (64 at least)."""
    bits = 1 << np.ceil(np.log2(np.maximum(sizes, 64))).astype(np.int64)
    ends = np.cumsum(bits)
    place = (ends - bits)[owner] + ((keys >> U64(20)) % bits[owner].astype(U64)).astype(np.int64)
    parity = np.bincount(place, minlength=int(bits.sum())) & 1
    data = np.packbits(parity.astype(np.uint8), bitorder="little").tobytes()
    return [data[(e - b) // 8:e // 8] for b, e in zip(bits.tolist(), ends.tolist(), strict=True)]


def _folded(sketch: bytes, n_words: int) -> np.ndarray:
    """A sketch at a smaller power of two bits."""
    out = np.frombuffer(sketch, np.uint64)
    while len(out) > n_words:
        out = out[:len(out) // 2] ^ out[len(out) // 2:]
    return out


def _groups(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows of side 0, rows of side 1) of each place in a part that has both."""
    sides = table.column("side").to_numpy()
    _, group = np.unique(table.column("place").to_numpy(), return_inverse=True)
    order = np.lexsort((sides, group))
    edges = np.searchsorted(group[order], np.arange(group.max(initial=-1) + 2))
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        members = order[lo:hi]
        one, two = members[sides[members] == 0], members[sides[members] == 1]
        if len(one) and len(two):
            yield one, two


def _within_bound(percent: int):
    """The sets that have a set of another component on the other side whose sketch is near enough for a link."""
    def run(table: pa.Table) -> pa.Table:
        sketches, kept = table.column("sketch").to_pylist(), np.zeros(table.num_rows, bool)
        n, joined = table.column("n").to_numpy(), table.column("joined").to_numpy()
        for one, two in _groups(table):
            n_words = min(len(sketches[i]) for side in (one, two) for i in side) // 8
            theirs = np.stack([_folded(sketches[i], n_words) for i in two])
            for i in one:
                differ = np.bitwise_count(theirs ^ _folded(sketches[i], n_words)).sum(axis=1, dtype=np.int64)
                near = (100 + percent) * differ <= (100 - percent) * (n[i] + n[two])
                near &= 100 * np.minimum(n[i], n[two]) >= percent * np.maximum(n[i], n[two])
                near &= joined[two] != joined[i]
                if near.any():
                    kept[i] = True
                    kept[two[near]] = True
        return table.select(["node", "place", "side"]).filter(pa.array(kept))

    return run


def _near(places: DataFrame, sketches: DataFrame, n_parts: int, percent: int) -> DataFrame:
    """Of ``places`` (node, place, side, joined) the sets whose texts have to be compared there."""
    return (
        places.join(sketches, "node").withColumn("n", F.col("node.n")).withColumn("part", F.pmod("place", F.lit(n_parts)))
        .groupBy("part").applyInArrow(_within_bound(percent), f"node {NODE_STRUCT}, place long, side int")
    )


def _candidates(keyed: DataFrame, n_parts: int, width: int, percent: int) -> DataFrame:
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()  # what other steps left
        sender = _Sender(n_parts)
        for batch in batches:
            rows = row_array(batch)
            for a, b, data, offsets in slices(batch.column("text")):
                keys, owner = _sets(data, offsets, width)
                sizes = np.bincount(owner, minlength=b - a)
                chunk, of = chunk_keys(keys, owner, sizes, percent)
                owners, records = np.zeros(b - a, OWNER), np.zeros(len(chunk), KEY)
                copy_rows(owners, rows[a:b])
                owners["n"] = sizes
                ends = np.cumsum(sizes)
                for i, name in enumerate(("first", "second")):
                    total = np.concatenate([np.zeros(1, U64), np.cumsum(mix(keys + U64(i)))])
                    owners[name] = (total[ends] - total[ends - sizes]).view(np.int64)
                records["key"] = chunk
                for name in NODE_NAMES:
                    records[name] = owners[name][of]
                yield from sender.add(records, owners, _bit_sketches(keys, owner, sizes))
        yield from sender.send()
        give_back()

    return keyed.drop("part").mapInArrow(sketch, exchange.SCHEMA).groupBy("part").applyInArrow(_meet, FOUND_SCHEMA)


def _verify(width: int, percent: int):
    """Links between the texts of side 0 and those of side 1 of each place in a part, without those that close a cycle."""
    def run(table: pa.Table) -> pa.Table:
        nodes = np.zeros(table.num_rows, NODE)
        for name in NODE_NAMES:
            nodes[name] = table.column(name).to_numpy()
        sizes, sets = np.zeros(len(nodes), np.int64), []
        for a, b, data, offsets in slices(table.column("text")):
            keys, owner = _sets(data, offsets, width)
            sizes[a:b] = np.bincount(owner, minlength=b - a)
            sets.append(keys)
        keys = np.concatenate([*sets, np.zeros(0, U64)])
        ends = np.cumsum(sizes)
        links, label = [], np.arange(len(nodes))
        for one, two in _groups(table):
            label[one], label[two] = one, two
            theirs = np.concatenate([keys[ends[i] - sizes[i]:ends[i]] for i in two])
            of = np.repeat(np.arange(len(two)), sizes[two])
            for i in one:
                mine = keys[ends[i] - sizes[i]:ends[i]]
                at = np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)
                both = np.bincount(of[mine[at] == theirs], minlength=len(two))
                linked = two[100 * both >= percent * (sizes[i] + sizes[two] - both)]
                _, first = np.unique(label[linked], return_index=True)
                linked = linked[first]
                linked = linked[label[linked] != label[i]]
                for side in (one, two):
                    label[side[np.isin(label[side], label[linked])]] = label[i]
                links.append(_pairs(nodes[i], nodes[linked]))
        pairs = np.concatenate([*links, np.zeros(0, PAIR)])
        return pa.table([_structs(pairs, NODE_NAMES), _structs(pairs, NODE_NAMES, "other_")], ["a", "b"])

    return run


def _may_be_in(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``texts`` without most of the rows that ``wanted`` does not name.

    A bit of FILTER_WORDS * 64 is set for each row wanted, by its hash.  A filter of fixed size only lets more rows
    through when more are wanted than it has bits; the join that follows is exact.
    """
    word = F.pmod(F.shiftright("row.hash", 6), F.lit(FILTER_WORDS)).cast("int").alias("word")
    bit = F.expr("cast(row.hash & 63 as int)")
    words = wanted.select(word, F.expr("shiftleft(1L, cast(row.hash & 63 as int))").alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    return texts.select("*", word).join(F.broadcast(words), "word").filter(F.getbit("bits", bit) == 1).drop("word", "bits")


def _linked(keyed: DataFrame, wanted: DataFrame, n_parts: int, width: int, percent: int) -> DataFrame:
    """Verified links (a, b): ``wanted`` names the sets, a row that has each, and the place and side it is compared on."""
    texts = _may_be_in(keyed.select(F.struct(*ROW_NAMES).alias("row"), "text"), wanted).join(wanted, "row")
    return (
        texts.select("node.*", "text", "place", "side", F.pmod("place", F.lit(n_parts)).alias("part"))
        .groupBy("part").applyInArrow(_verify(width, percent), f"a {NODE_STRUCT}, b {NODE_STRUCT}")
    )


def _star_places(stars: DataFrame) -> DataFrame:
    """Leaders against their members, the members of large stars in blocks."""
    sizes = stage(stars.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")), "sizes")
    leaders = sizes.select("a", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")).select(
        F.col("a").alias("node"), F.xxhash64("a", "block").alias("place"), F.lit(0).alias("side"), F.xxhash64("a").alias("joined"))
    members = stars.join(sizes, "a").select(
        F.col("b").alias("node"), F.xxhash64("a", F.pmod(F.xxhash64("b"), F.col("blocks")).cast("int")).alias("place"), F.lit(1).alias("side"),
        F.xxhash64("b").alias("joined"))
    return leaders.unionByName(members)


def _open_places(stars: DataFrame, found: DataFrame) -> DataFrame:
    """Members that are not in their leader's component against the leader and all members, in blocks of both."""
    of = found.select("node", "component")
    whole = stars.unionByName(stars.select("a", F.col("a").alias("b")).distinct())
    known = stage(
        whole.join(of.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a", "left")
        .join(of.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b", "left")
        .select("a", "b", F.xxhash64(F.coalesce("cb", "b")).alias("joined"),
                (F.coalesce("ca", "a") != F.coalesce("cb", "b")).alias("outside")), "members")
    sizes = stage(
        known.groupBy("a").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("outside"), 1)).alias("n_outside"))
        .filter("n_outside > 0")
        .select("a", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"), F.ceil(F.col("n_outside") / BLOCK).cast("int").alias("outer")), "open")
    open_ = known.join(sizes, "a")
    inner, outer = (F.pmod(F.xxhash64("b", F.lit(s)), F.col(c)).cast("int") for s, c in ((0, "blocks"), (1, "outer")))
    ones = open_.filter("outside").withColumn("i", outer).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    twos = open_.withColumn("j", inner).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("outer") - 1)))
    place = F.xxhash64("a", "i", "j").alias("place")
    return ones.select(F.col("b").alias("node"), place, F.lit(0).alias("side"), "joined").unionByName(
        twos.select(F.col("b").alias("node"), place, F.lit(1).alias("side"), "joined"))


def _with_head(rows: DataFrame, of: DataFrame, key: str) -> DataFrame:
    """``rows`` joined on ``key`` with ``of``, which has each key once and in ``held`` how many rows have it.

    The keys of more than one in HEAD rows, fewer than HEAD of them, are joined by broadcast, so no task gets all rows of one.
    """
    many = of.filter(F.col("held") * HEAD > (of.agg(F.sum("held")).first()[0] or 0))
    head = F.broadcast(many.drop("held"))
    return rows.join(head, key).unionByName(rows.join(F.broadcast(many.select(key)), key, "left_anti").join(of.drop("held"), key))


def jaccard_join(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept, row_hash.

    Words are what stands between spaces and control characters 9 to 13, A-Z
    lower-cased; a text of fewer than ``width`` words is one shingle, one
    without words (or NULL) has none and links with nothing.  Documents link
    when ``100 * intersection >= percent * union`` (``percent`` from 1 to 100); ``component_id`` is the
    smallest doc_id that links reach, and its row is the one ``kept``.  doc_id has to be
    an integer (TypeError otherwise); a NULL one counts as smaller than any other
    and is given back as NULL.  Rows that share an id are told apart by 128 bits
    of hashes of id and text (``row_hash``); rows equal in both are each given.
    A text of any length is taken whole by one task.  An empty table gives an
    empty result.  Other columns are not read, whatever their names.
    """
    if not 1 <= percent <= 100:
        raise ValueError(f"percent is from 1 to 100, not {percent}")
    n_parts = exchange.parts(docs.sparkSession)
    keyed = exchange.with_row_key(docs, n_parts)
    found = stage(_candidates(keyed, n_parts, width, percent), "candidates", TEXT_ROWS)
    rows = found.filter(F.col("kind") == OWNERS).select("row", F.col("a").alias("node"))
    sketches = found.filter(F.col("kind") == SKETCHES).select(F.col("a").alias("node"), "sketch")
    least = F.min("row").alias("row"), F.count(F.lit(1)).alias("held")
    sets = stage(rows.filter("node.n > 0").groupBy("node").agg(*least), "sets")
    inside = found.filter(F.col("kind") == PAIRS).select("a", "b")
    met = found.filter(F.col("kind") == MET).select("a", "b")
    # the members that a task's leader stood for belong to the leader it met, too
    through = met.join(inside.select(F.col("a").alias("b"), F.col("b").alias("member")), "b").select("a", F.col("member").alias("b"))
    stars = stage(inside.unionByName(met).unionByName(through).distinct(), "stars")
    alike = 100 * F.least("a.n", "b.n") >= percent * F.greatest("a.n", "b.n")
    near = stage(stars.filter(alike).groupBy("b").agg(F.min("a").alias("a")), "near_stars")

    def wanted(places: DataFrame, name: str) -> DataFrame:
        return stage(_near(places, sketches, n_parts, percent).join(sets.select("node", "row"), "node"), name)

    def links(places: DataFrame) -> DataFrame:
        return stage(_linked(keyed, places, n_parts, width, percent), "links", TEXT_ROWS)

    reached = components(links(wanted(_star_places(near), "near")))
    places = wanted(_open_places(stars, reached), "open_places")
    if not places.isEmpty():
        reached = components(reached.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(links(places)))
    rooted = stage(sets.join(reached, "node", "left").select("node", "row", "held", F.coalesce("component", "node").alias("root")), "rooted")
    roots = stage(rooted.groupBy("root").agg(*least), "roots").withColumnRenamed("row", "component")
    classes = stage(_with_head(rooted.select("node", "held", "root"), roots, "root").drop("root"), "classes")
    out = _with_head(rows.filter("node.n > 0"), classes, "node").unionByName(rows.filter("node.n = 0").withColumn("component", F.col("row")))
    return out.select(original_id("row").alias("doc_id"), F.col("node.n").alias("n_shingles"),
                      original_id("component").alias("component_id"),
                      (F.col("row") == F.col("component")).alias("kept"), F.struct("row.hash", "row.more").alias("row_hash"))
