"""Documents with similar n-gram sets, linked by an exact Jaccard join over prefix trees."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnspark.llm.chunks import chunk_count, chunk_of, ordered_texts, signed
from churnspark.llm.components import components
from churnspark.llm.rows import blocks_of
from churnspark.llm.words import mixed, split_words, whole_windows, window_hashes, word_hashes
from churnspark.session import broadcast_if_small, broadcast_rows, staged

BUCKETS = 1 << 22  # of the frequency table that orders n-grams; its size does not depend on the corpus
SLICE, SALTS = 1 << 12, 64  # buckets in a row of counts; groups of tasks whose counts are added first
BLOCK = 64  # n-grams compared at a time on a path of the tree
LEADS, ROUNDS = 4, 2  # members that a group's others are compared with first, and how often that is done
BIG = 64  # members from which a component is visited as a whole
TILE = 256  # about so many members of a visited component and so many visitors meet in one group


def tokens(texts: list[bytes | None], width: int) -> tuple[np.ndarray, np.ndarray]:
    """56-bit hashes of the n-grams of all texts, and where each text's begin; shorter texts are one n-gram."""
    words = split_words(texts, lower=True)
    hashes = word_hashes(words)
    n = np.diff(words.first)
    full = whole_windows(words, width)
    found = window_hashes(hashes, width)[full] if len(full) else np.empty(0, np.uint64)
    text_of = words.text_of[full] if len(full) else np.empty(0, np.int64)
    for k in range(1, width):
        short = np.flatnonzero(n == k)
        if len(short):
            found = np.concatenate([found, window_hashes(hashes, k)[words.first[short]]])
            text_of = np.concatenate([text_of, short])
    order = np.argsort(text_of, kind="stable")
    return found[order] >> np.uint64(8), np.searchsorted(text_of[order], np.arange(len(texts) + 1))


def ordered_sets(texts: list[bytes | None], width: int, ranks: np.ndarray) -> list[np.ndarray]:
    """The distinct n-grams of each text in the global order: rank of the frequency first, then the hash."""
    found, at = tokens(texts, width)
    keys = found | (ranks[(found & np.uint64(BUCKETS - 1)).astype(np.int64)].astype(np.uint64) << np.uint64(56))
    return [np.unique(keys[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]


def needed(one: int, two: int, percent: int) -> int:
    """Shared n-grams from which sets of these sizes link."""
    return -(-percent * (one + two) // (100 + percent))


def in_order(sets: list[np.ndarray]) -> list[int]:
    """Indexes of the sets in lexicographic order."""
    return sorted(range(len(sets)), key=lambda i: sets[i].astype(">u8").tobytes())


def linked(sets: list[np.ndarray], query: np.ndarray, percent: int, order: list[int] | None = None, most: int | None = None) -> list[int]:
    """Indexes of the ordered sets that link with the ordered query, of ``most`` sets at most; ``order`` is that of
    :func:`in_order` where it is known.

    The sets in lexicographic order are the leaves of a prefix tree in depth-first order. Partial overlaps are
    kept along the path and reused by all leaves below it; a leaf is left as soon as the overlap so far and what
    remains of either set cannot reach the number needed.
    """
    order = in_order(sets) if order is None else order
    longest = max((len(s) for s in sets), default=0)
    overlap = np.zeros(longest + 1, np.int64)  # shared n-grams up to each depth of the current path
    passed = np.zeros(longest + 1, np.int64)  # n-grams of the query up to each depth
    n, depth, shared, last, found = len(query), 0, 0, None, []
    for i in order:
        if len(found) == most:
            break
        one = sets[i]
        if last is not None:
            m = min(len(last), len(one))
            differ = np.flatnonzero(last[:m] != one[:m])[:1]
            shared = min(shared, int(differ[0]) if len(differ) else m)
        last = one
        need = needed(n, len(one), percent)
        d = min(shared, depth)
        while overlap[d] + min(n - passed[d], len(one) - d) >= need:
            if d == len(one):
                found.append(i)
                break
            run = one[d : d + BLOCK]
            at = np.searchsorted(query, run)
            hit = query[np.minimum(at, n - 1)] == run
            e = d + len(run)
            overlap[d + 1 : e + 1] = overlap[d] + np.cumsum(hit)
            passed[d + 1 : e + 1] = at + hit
            d = depth = e
            shared = len(one)
    return found


def pack(counts: np.ndarray) -> bytes:
    """Counts, compressed with all lowest bytes first, then all second bytes and so on."""
    return zlib.compress(counts.view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def unpack(packed: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(packed), np.uint8).reshape(8, -1).T).view(np.int64).ravel()


def frequency_ranks(docs: DataFrame, text_col: str, width: int) -> np.ndarray:
    """How frequent the n-grams of each hash bucket are: one more per doubling of the mean bucket (of 1, if that is less).

    Counted over all documents; the table has a fixed number of entries, so it can travel to every task. Tasks
    send packed slices of it, which are added up in two steps, so that each group stays small.
    """
    packed = "slice int, salt int, counts binary"

    def count(batches):
        total = np.zeros(BUCKETS, np.int64)
        waiting, n = [], 0

        def add():
            np.add(total, np.bincount(np.concatenate(waiting), minlength=BUCKETS), out=total)

        for batch in batches:
            for texts in blocks_of(batch.column(0).cast(pa.large_binary())):
                found, _ = tokens(texts, width)
                waiting.append((found & np.uint64(BUCKETS - 1)).astype(np.int64))
                n += len(found)
                if n >= BUCKETS:
                    add()
                    waiting, n = [], 0
        if n:
            add()
        salt = TaskContext.get().partitionId() % SALTS
        rows = [(k, pack(part)) for k, part in enumerate(total.reshape(-1, SLICE)) if part.any()]
        yield pa.RecordBatch.from_pydict({
            "slice": pa.array([k for k, _ in rows], pa.int32()),
            "salt": pa.array([salt] * len(rows), pa.int32()),
            "counts": pa.array([c for _, c in rows], pa.binary()),
        })

    def added(table: pa.Table) -> pa.Table:
        total = np.zeros(SLICE, np.int64)
        for c in table["counts"]:
            total += unpack(c.as_py())
        return table.slice(0, 1).set_column(2, "counts", pa.array([pack(total)], pa.binary()))

    counts = docs.select(docs[text_col].alias("text")).mapInArrow(count, packed)
    counts = counts.groupBy("slice", "salt").applyInArrow(added, packed).groupBy("slice").applyInArrow(added, packed)
    n = np.zeros(BUCKETS, np.int64)
    for row in counts.toLocalIterator():  # at most BUCKETS / SLICE rows
        n[row["slice"] * SLICE : (row["slice"] + 1) * SLICE] = unpack(row["counts"])
    return np.clip(np.log2(np.maximum(n / max(1.0, n.mean()), 1)), 0, 63).astype(np.uint8)  # keys stay positive as signed numbers


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, percent: int = 85) -> DataFrame:
    """Return per row of ``docs`` (<id>, n_shingles, component_id).

    Two documents link when their sets of ``width``-word n-grams (A-Z in lower case) have a Jaccard similarity
    of at least ``percent`` in a hundred; ``component_id`` is the smallest id reachable by links.

    * Documents with equal sets are one class, represented by its smallest id; only representatives go on.
    * Sets are ordered by global rarity. Two sets that link share an n-gram among the first few of each (the
      prefix), so only representatives that share one are compared.
    * Of the representatives that share a prefix n-gram each is first compared with a few of them, the same for
      most of its n-grams, and the links found are closed to components. Then all pairs that share a prefix
      n-gram, lie in different components and pass the bounds on sizes and shared prefixes are compared; a component
      of 64 or more is not paired member by member: its members and the documents that may link with one of them
      meet in groups of some hundreds of each, and a document is done with the first link found in a group.
      Pairs within a component need no further link and pairs across components are all covered.
    * Comparisons are exact, over prefix trees (see ``linked``); sets travel between chunks once per chunk.

    Every row is a document of its own, known by a 64-bit hash of id and text; rows equal in both are one. So rows that
    share an id, null included, link by their texts only. Documents without words (null, empty) have 0 n-grams and
    are alone. A component's smallest id is never null unless all its ids are. Extra columns are ignored; an empty
    table gives no rows.
    """
    ranks = frequency_ranks(docs, text_col, width)
    # From here on ``id`` is a row's hash, which also deals the rows to chunks, and ``doc`` the id of the document.
    texts = docs.select(docs[id_col].cast("long").alias("doc"), docs[text_col].alias("text"))
    texts = texts.select(F.xxhash64("doc", "text").alias("id"), "doc", "text")
    n_chunks = chunk_count(texts)
    texts = texts.withColumn("chunk", chunk_of("id", n_chunks))

    def prints(batches):
        for batch in batches:
            start = 0
            for raw in blocks_of(batch.column(2).cast(pa.large_binary())):
                sets = ordered_sets(raw, width, ranks)
                sums = [(s.sum(dtype=np.uint64), mixed(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)) for s in map(mixed, sets)]
                one, two = (np.array([s[k] for s in sums], np.uint64) for k in (0, 1))
                prefix = [s[: len(s) - (-(-percent * len(s) // 100)) + 1].view(np.int64) for s in sets]
                yield pa.RecordBatch.from_pydict({
                    "id": batch.column(0).slice(start, len(raw)),
                    "doc": batch.column(1).slice(start, len(raw)),
                    "size": pa.array([len(s) for s in sets], pa.int64()),
                    "one": signed(one),
                    "two": signed(two),
                    "prefix": pa.array(prefix, pa.list_(pa.int64())),
                })
                start += len(raw)

    printed = texts.select("id", "doc", "text").mapInArrow(prints, "id long, doc long, size long, one long, two long, prefix array<long>")
    printed = staged(printed.withColumn("row", F.monotonically_increasing_id()), "prints")
    firsts = printed.where("size > 0").groupBy("one", "two", "size").agg(F.min(F.struct("id", "row")).alias("first"))
    classes = staged(firsts.select("one", "two", "size", F.col("first.id").alias("rep"), "first.row"), "classes")

    def sets_of(left: pa.Table, wanted) -> dict[int, list[np.ndarray]]:
        """Distinct ordered sets of the wanted ids of a chunk."""
        ids, raw = ordered_texts(left)
        at = [i for i in range(len(ids)) if ids[i] in wanted]
        found: dict[int, list[np.ndarray]] = {}
        for i, s in zip(at, ordered_sets([raw[i] for i in at], width, ranks), strict=True):
            mine = found.setdefault(int(ids[i]), [])
            if len(s) and not any(np.array_equal(s, m) for m in mine):
                mine.append(s)
        return found

    reps = printed.join(classes.select("row"), "row", "left_semi").select("id", "size", "prefix")
    index = reps.select(F.posexplode("prefix").alias("pos", "token"), "id", "size")
    same = Window.partitionBy("token")
    index = index.withColumn("n", F.count("*").over(same)).where("n > 1").select("token", "id", "pos", "size")
    last = F.element_at("prefix", -1)  # where the prefix ends; unknown for an id with several texts
    ends = printed.where("size > 0").groupBy("id").agg(F.when(F.min(last) == F.max(last), F.min(last)).alias("end"))
    index = index.join(staged(ends, "ends"), "id").withColumn("chunk", chunk_of("id", n_chunks))
    index = staged(index, "index")

    def fetch(left: pa.Table, right: pa.Table) -> pa.Table:
        found = sets_of(left, set(right["id"].to_pylist()))
        to, ids, sets = [], [], []
        for t, i in zip(right["to"].to_pylist(), right["id"].to_pylist(), strict=True):
            for s in found.get(i, ()):
                to.append(t)
                ids.append(i)
                sets.append(s.tobytes())
        return pa.table({"chunk": pa.array(to, pa.int64()), "other": pa.array(ids, pa.int64()), "set": pa.array(sets, pa.binary())})

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        wanted: dict[int, set[int]] = {}
        visitors: list[tuple[int, np.ndarray]] = []
        for i, other, s in zip(*(right[c].to_pylist() for c in ("id", "other", "set")), strict=True):
            if s is not None:
                visitors.append((other, np.frombuffer(s, np.uint64)))
            else:
                wanted.setdefault(other, set()).add(i)
        here = sets_of(left, set().union(*wanted.values()))
        a, b = [], []
        for other, query in visitors:
            leaves = [(i, s) for i in sorted(wanted.get(other, ())) for s in here.get(i, ())]
            for k in linked([s for _, s in leaves], query, percent):
                a.append(leaves[k][0])
                b.append(other)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    def texts_of(ids: DataFrame):
        """The texts of the ids, by chunk; other documents stay where they are, if the list is small enough to broadcast."""
        ids = staged(ids.distinct(), "ids")
        few = ids.count() <= broadcast_rows(ids)
        return (texts.join(F.broadcast(ids), "id", "left_semi") if few else texts).select("chunk", "id", "text").groupBy("chunk")

    def compared(pairs: DataFrame) -> DataFrame:
        """The linked ones among pairs (id, chunk, other, other_chunk)."""
        wanted = pairs.select("chunk", "id", "other")
        by_chunk = texts_of(pairs.select("id").unionByName(pairs.select(F.col("other").alias("id"))))
        asked = pairs.select(F.col("other_chunk").alias("chunk"), F.col("other").alias("id"), F.col("chunk").alias("to")).distinct()
        sent = by_chunk.cogroup(asked.groupBy("chunk")).applyInArrow(fetch, "chunk long, other long, set binary")
        sent = sent.select("chunk", F.lit(None).cast("long").alias("id"), "other", "set")
        both = wanted.withColumn("set", F.lit(None).cast("binary")).unionByName(sent)
        return by_chunk.cogroup(both.groupBy("chunk")).applyInArrow(compare, "a long, b long")

    def bring(left: pa.Table, right: pa.Table) -> pa.Table:
        found = sets_of(left, set(right["id"].to_pylist()))
        rows = [(k, s.tobytes()) for k, i in enumerate(right["id"].to_pylist()) for s in found.get(i, ())]
        told = right.select(["component", "row", "col", "member", "id"]).take(pa.array([k for k, _ in rows], pa.int64()))
        return told.append_column("set", pa.array([s for _, s in rows], pa.binary()))

    def meet(table: pa.Table) -> pa.Table:
        ids, member = table["id"].to_pylist(), table["member"].to_pylist()
        sets = [np.frombuffer(s, np.uint64) for s in table["set"].to_pylist()]
        leaves = [k for k, m in enumerate(member) if m]
        held = [sets[k] for k in leaves]
        order = in_order(held)
        pairs = [(ids[leaves[i]], ids[k]) for k, m in enumerate(member) if not m for i in linked(held, sets[k], percent, order, 1)]
        return pa.table({"a": pa.array([a for a, _ in pairs], pa.int64()), "b": pa.array([b for _, b in pairs], pa.int64())})

    def visited(visits: DataFrame, members: DataFrame) -> DataFrame:
        """A link of each visit (id, chunk, component) to some member (id, chunk, component), if there is one."""
        numbers = visits.groupBy("component").agg(F.ceil(F.count("*") / TILE).cast("int").alias("cols"))
        tiles = members.groupBy("component").agg(F.ceil(F.count("*") / TILE).cast("int").alias("rows")).join(numbers, "component")
        upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        dealt = lambda n: F.pmod(F.xxhash64(F.lit(n), "id"), F.col(n)).cast("int")
        asked = members.join(tiles, "component").withColumn("member", F.lit(True)).withColumn("row", dealt("rows")).withColumn("col", upto("cols"))
        come = visits.join(tiles, "component").withColumn("member", F.lit(False)).withColumn("col", dealt("cols")).withColumn("row", upto("rows"))
        asked = asked.unionByName(come).select("chunk", "component", "row", "col", "member", "id")
        sent = texts_of(asked.select("id")).cogroup(asked.groupBy("chunk"))
        sent = sent.applyInArrow(bring, "component long, row int, col int, member boolean, id long, set binary")
        return sent.groupBy("component", "row", "col").applyInArrow(meet, "a long, b long")

    def prefix_bounded(pairs: DataFrame) -> DataFrame:
        """The pairs that can link by all n-grams that their prefixes share.

        Up to where the first of the two prefixes ends just these are shared; no more can be than follow that end in
        either set.
        """
        ids = staged(pairs.select("id").unionByName(pairs.select(F.col("other").alias("id"))).distinct(), "ids")
        held = printed.join(broadcast_if_small(ids), "id", "left_semi")
        held = held.select("id", "one", "two", "size", "prefix").repartition("id").dropDuplicates(["id", "one", "two"]).select("id", "size", "prefix")
        there = held.select(F.col("id").alias("other"), F.col("size").alias("other_size"), F.col("prefix").alias("other_prefix"))
        both = pairs.join(held.hint("merge"), "id").join(there.hint("merge"), "other")
        x, y = F.col("size"), F.col("other_size")
        end = F.least(F.element_at("prefix", -1), F.element_at("other_prefix", -1))
        after = lambda n, c: n - F.size(F.filter(c, lambda t: t <= end))
        most = F.size(F.array_intersect("prefix", "other_prefix")) + F.least(after(x, "prefix"), after(y, "other_prefix"))
        return both.where(most >= F.ceil(F.lit(percent) * (x + y) / (100 + percent))).select(*pairs.columns).distinct()

    told = ["id", "chunk", "size", "pos", "end"]  # of a member of a prefix n-gram's group

    def as_other(*cols):
        return [F.col(c).alias("other" if c == "id" else f"other_{c}") for c in cols]

    def bounded(met: DataFrame, part: float = 1.0) -> DataFrame:
        """Pairs that can link, from one row per n-gram that both prefixes hold, with sizes, positions and prefix ends.

        Up to where the first of the two prefixes ends the pair shares just the n-grams counted here. Whatever
        else it shares comes after that end, and after the last n-gram counted here in both sets. Where not all
        shared n-grams are counted, ``part`` of the number is asked for.
        """
        x, y = F.col("size"), F.col("other_size")
        rest = lambda n: F.ceil(F.lit(percent) * n / 100) - 1  # noqa: E731  n-grams after the prefix
        need = F.ceil(F.lit(percent) * (x + y) / (100 + percent))
        p, q = F.col("pos"), F.col("other_pos")
        met = met.where(100 * F.least(x, y) >= percent * F.greatest(x, y))
        met = met.where(F.least(p, q) + 1 + F.least(x - p - 1, y - q - 1) >= need)  # most that can be shared, by place
        met = met.groupBy("id", "chunk", "size", "end", "other", "other_chunk", "other_size", "other_end").agg(
            F.count("*").alias("shared"), F.max("pos").alias("pos"), F.max("other_pos").alias("other_pos")
        )
        first = F.col("end") <= F.col("other_end")
        after = F.when(first, rest(x)).when(~first, rest(y)).otherwise(F.greatest(rest(x), rest(y)))
        more = F.least(after, x - F.col("pos") - 1, y - F.col("other_pos") - 1)
        return met.where(F.col("shared") >= (need - more) * part).select("id", "chunk", "other", "other_chunk")

    def first_bounded(met: DataFrame) -> DataFrame:
        """Pairs that can link, from the n-grams that may be the first one shared, by sizes and places.

        Those lie near the start of both sets, and of the ones that are shared there none is left out: whatever else
        is shared comes after the last of them.
        """
        x, y = F.col("size"), F.col("other_size")
        need = F.ceil(F.lit(percent) * (x + y) / (100 + percent))
        met = met.where(100 * F.least(x, y) >= percent * F.greatest(x, y))
        met = met.where(F.least(x - F.col("pos"), y - F.col("other_pos")) >= need)
        met = met.groupBy("id", "chunk", "size", "other", "other_chunk", "other_size").agg(
            F.count("*").alias("shared"), F.max("pos").alias("pos"), F.max("other_pos").alias("other_pos")
        )
        after = F.least(x - F.col("pos") - 1, y - F.col("other_pos") - 1)
        return met.where(F.col("shared") + after >= need).select("id", "chunk", "other", "other_chunk")

    tested = links = None
    part = index.withColumn("component", F.col("id")).repartition("token")
    for turn in range(ROUNDS):
        # Each member of a group against a few others of it, drawn by hash and so the same for most n-grams.
        draws = [F.min(F.struct(F.xxhash64(F.lit(turn * LEADS + k), "id").alias("draw"), *told, "component")).over(same) for k in range(LEADS)]
        met = part.withColumn("leads", F.array(*draws))
        met = met.withColumn("lead", F.explode(F.array_distinct(F.transform("leads", lambda x: x.dropFields("draw")))))
        met = met.where(F.col("component") != F.col("lead.component"))
        met = met.select(*told, *[F.col(f"lead.{c}").alias("other" if c == "id" else f"other_{c}") for c in told])
        pairs = staged(bounded(met, 0.5), "pairs")
        new = staged(compared(pairs), "links")
        tested = pairs if tested is None else tested.unionByName(pairs)
        links = new if links is None else links.unionByName(new)
        joined = components(links)
        # What is open: members of different components that share an n-gram.
        part = index.join(joined, "id", "left").withColumn("component", F.coalesce("component", "id"))
        apart = F.min("component").over(same) != F.max("component").over(same)
        part = part.withColumn("apart", apart).where("apart").drop("apart")
    sizes = joined.groupBy("component").agg((F.count("*") + 1).alias("members"))
    part = staged(part.join(sizes, "component", "left").fillna(1, ["members"]), "open")
    # The first n-gram that two linked sets share has no shared one before it: all others come after it in both. So
    # two components meet at an n-gram only if for some two of their members enough can come after it.
    places = [F.min("size").alias("low"), F.max("size").alias("high"), F.max(F.expr("size - pos - 1")).alias("left")]
    sides = part.groupBy("token", "component", "members").agg(*places)
    sides = staged(sides, "sides")
    hosts = sides.select("token", F.col("component").alias("host"), *[F.col(c).alias(f"host_{c}") for c in ("members", "low", "high", "left")])
    sides = sides.hint("merge").join(hosts, "token").where(F.struct("members", "component") < F.struct("host_members", "host"))
    sides = sides.where(100 * F.least("high", "host_high") >= percent * F.greatest("low", "host_low"))
    need = F.ceil(F.lit(percent) * (F.col("low") + F.col("host_low")) / (100 + percent))
    sides = sides.where(1 + F.least("left", "host_left") >= need)
    sides = sides.select("token", "component", "host", "host_members")
    # A large component is visited: its members are not paired one by one.
    large = part.where(F.col("members") >= BIG).select("chunk", "component", "id").distinct()
    visits = part.hint("merge").join(sides.where(F.col("host_members") >= BIG), ["token", "component"])
    visits = staged(visits.select("id", "chunk", F.col("host").alias("component")).distinct(), "visits")
    beyond = part.select("token", F.col("component").alias("host"), *as_other(*told))
    met = part.hint("merge").join(sides.where(F.col("host_members") < BIG), ["token", "component"]).join(beyond.hint("merge"), ["token", "host"])
    pairs = first_bounded(met)
    known = tested.select("id", "other").unionByName(tested.select(F.col("other").alias("id"), F.col("id").alias("other")))
    pairs = staged(pairs.join(known, ["id", "other"], "left_anti"), "pairs")
    pairs = staged(prefix_bounded(pairs), "pairs")
    links = links.unionByName(compared(pairs)).unionByName(visited(visits, large))
    # Rows with equal sets.
    same_set = classes.drop("row").join(printed, ["one", "two", "size"]).where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    joined = components(links.unionByName(same_set))

    found = printed.select("id", "doc", "size").join(joined, "id", "left")
    found = staged(found.withColumn("component", F.when(F.col("size") > 0, F.coalesce("component", "id"))), "found")
    smallest = found.groupBy("component").agg(F.min("doc").alias("smallest"))
    return found.join(smallest, "component", "left").select(
        F.col("doc").alias(id_col),
        F.col("size").alias("n_shingles"),
        F.when(F.col("size") > 0, F.col("smallest")).otherwise(F.col("doc")).alias("component_id"),
    )
