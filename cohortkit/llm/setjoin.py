"""Jaccard join of documents as sets of word shingles, size-aware.

Light sets (smaller than a boundary chosen by cost) list all their subsets of the
overlap that a partner needs; two of them share a subset exactly when they link, so
a subset's documents form a star of links and no pair is listed. Heavy sets, and
the light ones that can link with them, go to inverted lists by their rarest
shingles, half as many more as linked sets need to share one of them, so that they
share several. Counting the lists gives each listed shingle its exact number of sets.
A set that has too few shingles in common with any other leaves all lists; the rest keep the
shingles that fewest sets list, again just as many as linked sets need to share one. Candidates in a list are compared
with one of its members at a time (hubs), the one whose listed shingles are the most widely listed: of
near copies it differs least from the others, so that it links with copies that do not link among
themselves. Lists whose members turn out connected need no more, and what is left between components is compared pair by pair. A pair
need only meet in the list of its first common shingle, so each listed shingle carries its
place in the set's order, and a list makes a pair only if what both sets list
from there on can still be the overlap they need. Equal sets count as one throughout.

The boundary minimises the rows that enumeration and lists would write, from
the number of sets of each size. Rarity only orders the shingles: any order gives
the same links, so the first choice is an estimate from what tasks find frequent: shingles that
repeat in a task come last, the others by the frequency that their words let expect.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortkit.llm.components import connected_components
from cohortkit.llm.text import NOT_BLANK, Words, mix, slices
from cohortkit.session import broadcast_if_small, materialise

# Sizes up to which enumeration is considered, rows a set may enumerate, weight of a listed row (it has to be compared).
_LARGEST_LIGHT, _MOST_SUBSETS, _LIST_WEIGHT = 48, 1500, 4
# Count in a task from which a shingle is reported as frequent, and most of these that order the lists.
_OFTEN, _ORDERED = 3, 1 << 18
# Rounds of hubs before lists are joined pair by pair, at every size.
_HUB_ROUNDS = 1


class Rule:
    """Which sizes and overlaps link: ``den`` * intersection >= ``num`` * union."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den

    def smallest(self, n: int) -> int:
        return -(-self.num * n // self.den)

    def largest(self, n: int) -> int:
        return self.den * n // self.num

    def overlap(self, s: int, t: int) -> int:
        return -(-self.num * (s + t) // (self.num + self.den))

    def prefix(self, n: np.ndarray) -> np.ndarray:
        """Shingles of which sets that link share at least one, whatever the order."""
        return n - -(-self.num * n // self.den) + 1

    def extra(self, n: np.ndarray) -> np.ndarray:
        """Shingles listed beyond the prefix: linked sets share one, and as many more as the smaller set lists extra."""
        return np.minimum(self.prefix(n) // 2, -(-self.num * n // self.den) - 1)

    def listed(self, n: np.ndarray) -> np.ndarray:
        return np.minimum(n, self.prefix(n) + self.extra(n))

    def listed_column(self, n: Column) -> Column:
        return F.least(n, self._prefix_column(n) + self._extra_column(n))

    def kept_column(self, n: Column) -> Column:
        """How many of its listed shingles a set keeps: among them, in any order, is one of each partner's."""
        return self.listed_column(n) - self._extra_column(self._smallest_column(n))

    def _smallest_column(self, n: Column) -> Column:
        return F.ceil(n.cast("long") * self.num / self.den)

    def _prefix_column(self, n: Column) -> Column:
        return n - self._smallest_column(n) + 1

    def _extra_column(self, n: Column) -> Column:
        return F.least(F.floor(self._prefix_column(n) / 2), self._smallest_column(n) - 1)

    def partners(self, s: int, below: int) -> list[tuple[int, int]]:
        """(size, overlap needed) of each light partner of a set of size ``s``."""
        sizes = range(self.smallest(s), min(self.largest(s), below - 1) + 1)
        return [(t, self.overlap(s, t)) for t in sizes if self.overlap(s, t) <= min(s, t)]

    def subsets(self, s: int, below: int) -> int:
        return sum(math.comb(s, c) for _, c in self.partners(s, below))

    def boundary(self, sizes: dict[int, int]) -> int:
        """Size from which sets are heavy, at the least estimated number of rows."""
        best, at = None, 1
        for below in range(1, _LARGEST_LIGHT + 1):
            if below > 1 and self.subsets(below - 1, below) > _MOST_SUBSETS:
                break
            light = sum(n * self.subsets(s, below) for s, n in sizes.items() if 0 < s < below)
            heavy = sum(n * _LIST_WEIGHT * int(self.listed(np.array(s))) for s, n in sizes.items() if s >= self.smallest(below))
            if best is None or light + heavy < best:
                best, at = light + heavy, below
        return at


def shingle_sets(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each row's set starts (one more at the end), and all sets, sorted within a row.

    A text with fewer than ``k`` words is one shingle, its whole sequence; one without words has none.
    """
    words = Words(texts, NOT_BLANK)
    return _sets(words, words.hashes(), k, None)[:2]


def _sets(words: Words, h: np.ndarray, k: int, logs: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sets, and the expected log frequency of each shingle from its words' ``logs`` (of shares of all words)."""
    n = words.counts
    full = np.maximum(0, n - k + 1)
    row = np.repeat(np.arange(len(n)), full)
    start = np.arange(int(full.sum())) - np.repeat(np.cumsum(full) - full, full) + np.repeat(words.first[:-1], full)
    value = np.full(len(start), k, np.uint64)
    expected = np.zeros(len(start), np.float32)
    for i in range(k):
        value = mix(value * np.uint64(31) + h[start + i])
        if logs is not None:
            expected += logs[start + i]
    short = np.flatnonzero((n > 0) & (n < k))
    extra = n[short].astype(np.uint64)
    for i in range(k - 1):
        more = n[short] > i
        extra[more] = mix(extra[more] * np.uint64(31) + h[words.first[:-1][short[more]] + i])
    row, value = np.concatenate([row, short]), np.concatenate([value, extra])
    expected = np.concatenate([expected, np.zeros(len(short), np.float32)])
    order = np.lexsort((value, row))
    row, value, expected = row[order], value[order], expected[order]
    keep = np.concatenate([[True], (value[1:] != value[:-1]) | (row[1:] != row[:-1])]) if len(row) else np.zeros(0, bool)
    return np.searchsorted(row[keep], np.arange(len(n) + 1)), value[keep], expected[keep]


def _prints(first: np.ndarray, sets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over each set; equal for equal sets."""
    total = np.zeros((2, len(sets) + 1), np.uint64)
    np.cumsum(mix(sets), out=total[0, 1:])
    np.cumsum(mix(sets ^ np.uint64(0xA5A5A5A5A5A5A5A5)), out=total[1, 1:])
    return total[0, first[1:]] - total[0, first[:-1]], total[1, first[1:]] - total[1, first[:-1]]


def _sketches(first: np.ndarray, sets: np.ndarray) -> pa.Array:
    """How many shingles of each set fall into each of 64 hash classes, a byte each, or four if a class has more than 255.

    The sum of the smaller counts bounds an intersection from above.
    """
    rows = len(first) - 1
    row = np.repeat(np.arange(rows), np.diff(first))
    counts = np.bincount((row << 6) | (sets >> np.uint64(58)).astype(np.int64), minlength=rows << 6).reshape(rows, 64)
    wide = (counts > 255).any(1).tolist()
    return pa.array([x.astype("<u4" if w else np.uint8).tobytes() for x, w in zip(counts, wide, strict=True)], pa.binary())


def _counts(sketches: pa.Array) -> np.ndarray:
    """The class counts of sketches of either width, a row each."""
    raw = sketches.to_pylist()
    wide = np.array([len(x) > 64 for x in raw], bool)
    out = np.empty((len(raw), 64), np.uint32)
    out[~wide] = np.frombuffer(b"".join(x for x in raw if len(x) == 64), np.uint8).reshape(-1, 64)
    out[wide] = np.frombuffer(b"".join(x for x in raw if len(x) > 64), "<u4").reshape(-1, 64)
    return out


def _may_link(rule: Rule):
    """Pairs whose sketches leave room for the overlap they need."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (_counts(batch.column(c)) for c in ("sketch_a", "sketch_b"))
            most = np.minimum(a, b).sum(1, dtype=np.int64)
            total = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            yield batch.select(["a", "b"]).filter(pa.array((rule.num + rule.den) * most >= rule.num * total))

    return keep


def _profile(k: int):
    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                words = Words(batch.column("text"), NOT_BLANK)
                h = words.hashes()
                first, sets, _ = _sets(words, h, k, None)
                one, two = _prints(first, sets)
                _, fresh = np.unique(one, return_index=True)
                own = np.zeros(len(one), bool)
                own[fresh] = True
                found = []
                for values in (sets[np.repeat(own, np.diff(first))], h):
                    values, n = np.unique(values, return_counts=True)
                    often = n >= _OFTEN
                    found.append((values[often].view(np.int64), n[often]))
                tokens, n = (np.concatenate(x) for x in zip(*found, strict=True))
                is_word = np.repeat([False, True], [len(v) for v, _ in found])
                rows, more = batch.num_rows, len(tokens)
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([batch.column("doc_id"), pa.nulls(more, pa.int64())]),
                     pa.concat_arrays([pa.array(np.diff(first)), pa.nulls(more, pa.int64())]),
                     pa.concat_arrays([pa.array(one.view(np.int64)), pa.nulls(more, pa.int64())]),
                     pa.concat_arrays([pa.array(two.view(np.int64)), pa.nulls(more, pa.int64())]),
                     pa.concat_arrays([pa.nulls(rows, pa.int64()), pa.array(tokens)]),
                     pa.concat_arrays([pa.nulls(rows, pa.int64()), pa.array(n.astype(np.int64))]),
                     pa.concat_arrays([pa.nulls(rows, pa.bool_()), pa.array(is_word)]),
                     pa.concat_arrays([pa.array(words.counts.astype(np.int64)), pa.nulls(more, pa.int64())]),
                     pa.concat_arrays([_sketches(first, sets), pa.nulls(more, pa.binary())])],
                    names=["doc_id", "n", "one", "two", "token", "often", "word", "words", "sketch"])

    return profile


def _keys(k: int, rule: Rule, below: int, frequent):
    """Rows (kind, token, doc_id, n, one) of the sets of a task, equal sets once per batch.

    Kind 0 is an inverted list, 1 a subset for partners of the same size, 2 one for partners of two sizes.
    """

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, level, known, share, rare = frequent.value
        for whole in batches:
            for batch in slices(whole, "text", 4 << 20):
                words = Words(batch.column("text"), NOT_BLANK)
                h = words.hashes()
                spot = np.minimum(np.searchsorted(known, h), max(0, len(known) - 1))
                logs = np.where(known[spot] == h, share[spot], rare) if len(known) else np.full(len(h), rare, np.float32)
                first, sets, expected = _sets(words, h, k, logs)
                one, _ = _prints(first, sets)
                ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
                n = np.diff(first)
                order = np.lexsort((ids, one))
                keep = order[np.concatenate([[True], one[order][1:] != one[order][:-1]])]
                keep = np.sort(keep[n[keep] > 0])
                row_of = np.repeat(np.arange(len(n)), n)
                # Inverted lists: the rarest shingles first, then by hash.
                at = np.minimum(np.searchsorted(common, sets), max(0, len(common) - 1))
                rank = np.where(common[at] == sets, level[at], 0) if len(common) else np.zeros(len(sets), np.uint8)
                listed = np.zeros(len(n), bool)
                listed[keep] = n[keep] >= rule.smallest(below)
                some = np.flatnonzero(listed[row_of])
                some = some[np.lexsort((sets[some], np.round(expected[some], 2), rank[some], row_of[some]))]
                place = np.arange(len(some)) - np.searchsorted(row_of[some], row_of[some])
                some = some[place < rule.listed(n)[row_of[some]]]
                token, row, kind = [sets[some]], [row_of[some]], [np.zeros(len(some), np.int32)]
                values = mix(sets)
                for r in keep[n[keep] < below]:
                    mine = values[first[r] : first[r + 1]]
                    total, size = one[r], len(mine)
                    for other, c in rule.partners(size, below):
                        if c == size:
                            subset = np.array([total], np.uint64)
                        elif c == size - 1:
                            subset = total - mine
                        else:
                            subset = total - np.array([mine[list(x)].sum(dtype=np.uint64) for x in combinations(range(size), size - c)], np.uint64)
                        pair = np.full(1, min(size, other) * 4096 + max(size, other), np.uint64)
                        token.append(mix(mix(subset) + mix(pair)))
                        row.append(np.full(len(subset), r))
                        kind.append(np.full(len(subset), 1 if other == size else 2, np.int32))
                token, row, kind = (np.concatenate(x) for x in (token, row, kind))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(kind), pa.array(token.view(np.int64)), pa.array(ids[row].astype(np.int64)), pa.array(n[row].astype(np.int32)),
                     pa.array(one[row].view(np.int64))],
                    names=["kind", "token", "doc_id", "n", "one"])

    return keys


def _compare(k: int, rule: Rule):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text_a", 4 << 20):
                fa, a = shingle_sets(batch.column("text_a"), k)
                fb, b = shingle_sets(batch.column("text_b"), k)
                na, nb = np.diff(fa), np.diff(fb)
                row = np.concatenate([np.repeat(np.arange(len(na)), na), np.repeat(np.arange(len(nb)), nb)])
                value = np.concatenate([a, b])
                order = np.lexsort((value, row))
                row, value = row[order], value[order]
                both = np.bincount(row[1:][(value[1:] == value[:-1]) & (row[1:] == row[:-1])], minlength=len(na)) if len(row) else np.zeros(len(na), np.int64)
                linked = (rule.den * both >= rule.num * (na + nb - both)) & (na > 0) & (nb > 0)
                yield pa.RecordBatch.from_arrays([c.filter(pa.array(linked)) for c in (batch.column("a"), batch.column("b"))], names=["a", "b"])

    return compare


def _members(lists: DataFrame, groups: DataFrame | None) -> DataFrame:
    """Lists whose members lie in several components: token, part, doc_id, n, place, component."""
    if groups is None:
        found = lists.withColumn("component", F.col("doc_id"))
    else:
        found = lists.join(groups.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left").withColumn(
            "component", F.coalesce("component", "doc_id"))
    mixed = found.groupBy("token", "part").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("token", "part")
    return found.join(mixed, ["token", "part"])


def components(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id.

    Documents link when ``den`` times the intersection of their ``k``-word shingle
    sets is at least ``num`` times the union; ``component_id`` is the smallest
    doc_id reachable by links. Words lie between blanks, A-Z in lower
    case. A text without words (or null) has an empty set and links with nothing.
    Rows that share an id are one document for the links; a null id
    takes no part and has no component; other columns are left out; an empty table
    gives no rows.
    """
    spark, rule = docs.sparkSession, Rule(num, den)
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    profile = materialise(chosen.mapInArrow(_profile(k), "doc_id long, n long, one long, two long, token long, often long, word boolean, words long, sketch binary"), "set-profile")
    rows = profile.where("token is null").select("doc_id", "n", "one", "two")
    taking = profile.where("token is null and n > 0 and doc_id is not null")
    classes = materialise(
        taking.groupBy("one", "two", "n").agg(F.min("doc_id").alias("first"), F.first("sketch").alias("sketch")), "set-classes")
    sizes = {r["n"]: r["c"] for r in classes.groupBy(F.least("n", F.lit(2 * _LARGEST_LIGHT)).alias("n")).agg(F.count("*").alias("c")).collect()}
    below = rule.boundary(sizes)
    # At most ``_ORDERED`` shingles and words with a number each: a proven bound for the broadcast.
    tables = []
    for kind in ("not word", "word"):
        often = profile.where("token is not null").where(kind).groupBy("token").agg(F.sum("often").alias("c")).orderBy(
            F.desc("c"), "token").limit(_ORDERED).toPandas()
        tokens, counts = often["token"].to_numpy(np.int64).view(np.uint64), np.log2(1 + often["c"].to_numpy(float))
        order = np.argsort(tokens)
        tables += [tokens[order], counts[order].astype(np.uint8 if kind == "not word" else np.float32)]
    every = math.log2(1 + (profile.agg(F.sum("words")).first()[0] or 0))
    frequent = spark.sparkContext.broadcast((*tables[:3], tables[3] - np.float32(every), np.float32(-every)))

    keys = chosen.where("doc_id is not null").mapInArrow(
        _keys(k, rule, below, frequent), "kind int, token long, doc_id long, n int, one long")
    same = Window.partitionBy("kind", "token")
    # Two sets of a subset link if their sizes are the two that it stands for; sets of both sizes link all of them.
    shared = keys.withColumns({"x": F.min("one").over(same), "y": F.max("one").over(same), "s": F.min("n").over(same), "t": F.max("n").over(same)}).where(
        "x <> y and (kind < 2 or s < t)")
    lists = materialise(shared.groupBy("kind", "token", "one", "n").agg(F.min("doc_id").alias("doc_id")).withColumn(
        "sets", F.count("*").over(same)), "set-lists")
    stars = lists.where("kind > 0").groupBy("kind", "token").agg(F.min("doc_id").alias("a"))
    links = materialise(lists.where("kind > 0").join(stars, ["kind", "token"]).select("a", F.col("doc_id").alias("b")).where("a <> b").distinct(), "links")
    # A list is cut by size, each set into its own part and the next one, so that partners meet and others do not.
    step = math.log(den / num)
    part = F.floor(F.log(F.col("n").cast("double")) / step + 1e-9)
    # A set's listed shingles by the number of sets that list them; those of no other set come first and need no list.
    own = Window.partitionBy("one", "n")
    place = rule.listed_column(F.col("n")) - F.count("*").over(own) + F.row_number().over(own.orderBy("sets", "token")) - 1
    # How far a set stands apart: the mean over its listed shingles of one in the number of sets that list each.
    apart = (1 + (F.sum(1 / F.col("sets") - 1).over(own) / rule.listed_column(F.col("n")))).cast("float")
    rarest = lists.where("kind = 0").withColumns({"place": place, "apart": apart}).where(F.col("place") < rule.kept_column(F.col("n")))
    heavy = rarest.select("token", F.explode(F.array(part, part + 1)).alias("part"), "doc_id", "n", "place", "apart")
    members = materialise(_members(heavy, None), "set-members")
    heavy = members.drop("component")

    def compared(pairs: DataFrame) -> DataFrame:
        # Sketches rule most pairs out; only the texts of the rest are fetched.
        left, right = (
            classes.select(F.col("first").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"sketch_{c}")) for c in ("a", "b"))
        rest = materialise(
            pairs.distinct().join(left, "a").join(right, "b").mapInArrow(_may_link(rule), "a long, b long"), "set-pairs")
        wanted = rest.select(F.col("a").alias("doc_id")).unionByName(rest.select(F.col("b").alias("doc_id"))).distinct()
        texts = materialise(chosen.join(broadcast_if_small(wanted), "doc_id", "left_semi"), "set-texts")
        left, right = (texts.select(F.col("doc_id").alias(c), F.col("text").alias(f"text_{c}")) for c in ("a", "b"))
        both = rest.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
        return materialise(both.mapInArrow(_compare(k, rule), "a long, b long"), "links")

    other = [F.col("doc_id").alias("b"), F.col("n").alias("m"), F.col("place").alias("at"), F.col("component").alias("other")]
    fit = F.least("n", "m") * den >= F.greatest("n", "m") * num
    # Sets of one part also meet in the next one: the larger own part is the place of the pair.
    here = F.col("part") == F.floor(F.log(F.greatest("n", "m").cast("double")) / step + 1e-9)
    # With these shingles as the first common ones, what both list from there on must hold the overlap but for what neither lists.
    n_listed, m_listed = rule.listed_column(F.col("n")), rule.listed_column(F.col("m"))
    left_over = F.least(n_listed - F.col("place"), m_listed - F.col("at")) + F.greatest(F.col("n") - n_listed, F.col("m") - m_listed)
    reach = left_over * (num + den) >= (F.col("n") + F.col("m")) * num
    groups = None
    for turn in range(_HUB_ROUNDS + 1):
        if turn:
            members = materialise(_members(heavy, groups), "set-members")
        if members.isEmpty():
            break
        last = turn == _HUB_ROUNDS
        if last:
            pairs = members.join(members.select("token", "part", *other), ["token", "part"]).where((F.col("component") < F.col("other")) & here & fit & reach)
        else:
            hubs = members.groupBy("token", "part").agg(
                F.min_by(F.struct("doc_id", "n", "place", "component"), F.struct("apart", F.xxhash64("doc_id", F.lit(turn)))).alias("hub"))
            hubs = hubs.select("token", "part", F.col("hub.doc_id").alias("b"), F.col("hub.n").alias("m"), F.col("hub.place").alias("at"), F.col("hub.component").alias("other"))
            pairs = members.join(hubs, ["token", "part"]).where((F.col("component") != F.col("other")) & here & fit & reach)
        found = compared(pairs.select(F.least("doc_id", "b").alias("a"), F.greatest("doc_id", "b").alias("b")))
        links = links.unionByName(found) if groups is None else found.unionByName(
            groups.where("node <> component").select(F.col("component").alias("a"), F.col("node").alias("b")))
        groups = materialise(connected_components(links), "set-groups")
        if last:
            break
    if groups is None:
        groups = connected_components(links)
    return _result(rows, classes, groups)


def _result(rows: DataFrame, classes: DataFrame, groups: DataFrame) -> DataFrame:
    named = classes.join(groups.select(F.col("node").alias("first"), "component"), "first", "left").select(
        "one", "two", "n", F.coalesce("component", "first").alias("component"))
    return rows.join(named, ["one", "two", "n"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest id; documents that link with nothing stay.

    Rows that share an id and a text are copies, of which one stays; rows that share an id only are
    parts of one document and stay or go together. A row without an id takes no part and stays.
    """
    found = materialise(components(docs, k, num, den), "near-copies")
    dropped = found.where("component_id <> doc_id").select("doc_id").distinct()
    kept = docs.join(dropped, "doc_id", "left_anti")
    repeated = materialise(found.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"), "repeated-ids")
    if repeated.isEmpty():
        return kept
    again = broadcast_if_small(repeated)
    return kept.join(again, "doc_id", "left_anti").unionByName(kept.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]).select(*kept.columns))
