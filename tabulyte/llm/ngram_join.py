"""N-gram Jaccard self-join by a token-group matrix.

Documents become sets of word shingles.  Similar sets are put in groups; the matrix
holds, per group, the union of its members' leading tokens.  A set looks up the
groups that one of its own leading tokens is in, its overlap with a group's token
union bounds its overlap with every member, and only groups that can hold a partner
are opened.  Sets that cannot have a partner drop out first: too many of their tokens
occur nowhere else.

The order of tokens is rare first, so leading tokens (of which two linked sets share
one) are seldom common passages.  Copies are one class.  Sets already in one component
are not compared again, so a group of thousands of near copies costs about one
comparison per member and not one per pair."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabulyte.llm import tally, words
from tabulyte.llm.components import components
from tabulyte.llm.scratch import kept, partitions

SHINGLE = 4
PERCENT = 85
GROUP = 256
VISITORS = 1024
_U = np.uint64


def _need(n, percent: int):
    """The overlap that every partner of a set of size n reaches."""
    return -(-percent * n // 100)


def _gather(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions starts[i] .. starts[i] + sizes[i] - 1 of all i, one after another."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


def shingle_keys(table: pa.Table, width: int):
    """Text of each shingle, its key and second hash; a text of fewer words is one shingle."""
    data, offsets = words.text_bytes(table.column("text"))
    data = words.LOWER[data]
    begin, end = words.word_spans(data, offsets)
    bounds = words.text_of(begin, offsets)
    hashes = words.word_hashes(data, begin, end)
    first, keys, second = words.windows(hashes, bounds, width)
    text = np.searchsorted(bounds, first, side="right") - 1
    for size in range(1, width):
        short = np.flatnonzero(np.diff(bounds) == size)
        acc = np.full(len(short), size, _U)
        for j in range(size):
            acc = words.mix(acc * _U(0xD6E8FEB86659FD93) + hashes[bounds[short] + j], size)
        text, keys, second = np.append(text, short), np.append(keys, acc), np.append(second, words.mix(acc, 99))
    return text, keys, second


class _Sets:
    """The distinct shingles of every text of a unit."""

    def __init__(self, table: pa.Table, width: int, layout: tally.Layout):
        text, keys, second = shingle_keys(table, width)
        self.keys = tally.Keys.of(keys, second, layout)
        n = max(len(self.keys.keys), 1)
        both = np.unique(text.astype(np.int64) * n + self.keys.place)
        self.text, self.place = both // n, both % n
        self.edges = np.searchsorted(self.text, np.arange(table.num_rows + 1))


def _sums(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(values) + 1, values.dtype)
    np.cumsum(values, out=sums[1:])
    return sums[edges[1:]] - sums[edges[:-1]]


def _send_sets(width, layout, table: pa.Table) -> pa.Table:
    sets = _Sets(table, width, layout)
    counts = np.bincount(sets.place, minlength=len(sets.keys.keys))
    return sets.keys.blobs(table.column("unit")[0].as_py(), counts)


def _describe(width, percent, layout, table: pa.Table, totals: pa.Table) -> pa.Table:
    """Size and signature of every set; its shared tokens if it can have a partner."""
    sets = _Sets(table, width, layout)
    edges, n = sets.edges, np.diff(sets.edges)
    keys = sets.keys.keys[sets.place]
    shared = sets.keys.totals(totals)[sets.place] >= 2
    can = (_sums(shared.astype(np.int64), edges) >= _need(n, percent)) & (n > 0)
    tokens = [keys[a:b][shared[a:b]].tobytes() if ok else None for a, b, ok in zip(edges[:-1], edges[1:], can)]
    return pa.table({
        "doc_id": table.column("doc_id"), "n_shingles": pa.array(n, pa.int64()),
        "sig_a": pa.array(_sums(words.mix(keys, 11), edges).view(np.int64)),
        "sig_b": pa.array(_sums(words.mix(keys, 12), edges).view(np.int64)),
        "tokens": pa.array(tokens, pa.binary()),
    })


def _class_keys(layout, table: pa.Table):
    blobs = table.column("tokens").to_pylist()
    tokens = np.frombuffer(b"".join(blobs), _U)
    edges = np.concatenate([[0], np.cumsum([len(b) // 8 for b in blobs])])
    return tally.Keys.of(tokens, words.mix(tokens, 9), layout), tokens, edges


def _send_classes(layout, table: pa.Table) -> pa.Table:
    keys, _, _ = _class_keys(layout, table)
    return keys.blobs(table.column("unit")[0].as_py(), keys.summed())


_RANKED = "class_id long, n long, tokens binary, lead array<long>, home long"


def _rank(percent, layout, table: pa.Table, totals: pa.Table) -> pa.Table:
    """Classes that can still have a partner, tokens rare first, with leading tokens."""
    keys, tokens, edges = _class_keys(layout, table)
    spread = keys.totals(totals)[keys.place]
    sizes = table.column("n").to_numpy()
    rows = []
    for i, class_id in enumerate(table.column("class_id").to_pylist()):
        own, by = tokens[edges[i] : edges[i + 1]], spread[edges[i] : edges[i + 1]]
        own, by = own[by >= 2], by[by >= 2]
        lead = len(own) - int(_need(sizes[i], percent)) + 1
        if lead > 0:
            own = own[np.lexsort((own, by))]
            rows.append((class_id, int(sizes[i]), own.tobytes(), own[:lead].view(np.int64), int(words.mix(own, 21).min().view(np.int64))))
    column = lambda k: [r[k] for r in rows]
    return pa.table({
        "class_id": pa.array(column(0), pa.int64()), "n": pa.array(column(1), pa.int64()), "tokens": pa.array(column(2), pa.binary()),
        "lead": pa.array(column(3), pa.list_(pa.int64())), "home": pa.array(column(4), pa.int64()),
    })


class _Group:
    """An inverted index over the sets of one group."""

    def __init__(self, blobs: list[bytes], sizes: np.ndarray):
        tokens = np.frombuffer(b"".join(blobs), _U)
        lengths = np.array([len(b) // 8 for b in blobs])
        owner = np.repeat(np.arange(len(blobs)), lengths)
        order = np.argsort(tokens, kind="stable")
        self.union, first = np.unique(tokens[order], return_index=True)
        self.owner = owner[order]
        self.first = np.append(first, len(tokens))
        self.sizes = sizes

    def partners(self, own: np.ndarray, n: int, percent: int) -> np.ndarray:
        """Members linked with the set `own` of full size n.  Its overlap with the token
        union bounds that with any member; a group below the need stays closed."""
        at = np.searchsorted(self.union, own)
        inside = at < len(self.union)
        at = at[inside]
        at = at[self.union[at] == own[inside]]
        if len(at) < _need(n, percent):
            return at[:0]
        both = np.bincount(self.owner[_gather(self.first[at], self.first[at + 1] - self.first[at])], minlength=len(self.sizes))
        return np.flatnonzero((both > 0) & (100 * both >= percent * (n + self.sizes - both)))


def _by(table: pa.Table, *names: str):
    """Row numbers of each distinct value of the columns."""
    rows = {}
    for i, key in enumerate(zip(*[table.column(c).to_pylist() for c in names])):
        rows.setdefault(key, []).append(i)
    return rows.values()


def _link_members(percent, table: pa.Table) -> pa.Table:
    """Components inside each group, as the smallest class of each."""
    ids = table.column("class_id").to_numpy()
    sizes = table.column("n").to_numpy()
    blobs = table.column("tokens").to_pylist()
    comp = ids.copy()
    for rows in _by(table, "g"):
        if len(rows) == 1:
            continue
        rows = np.array(rows)[np.argsort(ids[rows], kind="stable")]
        group = _Group([blobs[i] for i in rows], sizes[rows])
        label = np.arange(len(rows))
        for i in range(len(rows)):
            if (label != label[i]).any():
                near = np.unique(label[group.partners(np.frombuffer(blobs[rows[i]], _U), sizes[rows[i]], percent)])
                near = np.append(near, label[i])
                label[np.isin(label, near)] = near.min()
            else:
                break
        comp[rows] = ids[rows][label]
    out = table.append_column("comp", pa.array(comp, pa.int64()))
    return out.filter(pa.array(~table.column("pivot").to_numpy(zero_copy_only=False))).select(["g", "class_id", "n", "tokens", "lead", "comp"])


def _visit(percent, table: pa.Table) -> pa.Table:
    """Links between visiting sets and the members of each group, by component."""
    sizes = table.column("n").to_numpy()
    comps = table.column("comp").to_numpy()
    visits = table.column("visits").to_numpy(zero_copy_only=False)
    blobs = table.column("tokens").to_pylist()
    found = set()
    for rows in _by(table, "g", "slot"):
        rows = np.array(rows)
        members, guests = rows[~visits[rows]], rows[visits[rows]]
        if len(members) and len(guests):
            group = _Group([blobs[i] for i in members], sizes[members])
            for i in guests:
                near = comps[members[group.partners(np.frombuffer(blobs[i], _U), sizes[i], percent)]]
                found.update((int(comps[i]), int(c)) for c in np.unique(near) if c != comps[i])
    a, b = zip(*found) if found else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _bins(df: DataFrame, rows: int, *key: str):
    """Deal whole groups to bins of some hundred rows, so that small groups share a task."""
    n = max(4 * partitions(df.sparkSession), rows // 512)
    return df.withColumn("bin", F.pmod(F.xxhash64(*key), F.lit(n))).groupBy("bin")


def _linked_classes(ranked: DataFrame, percent: int) -> DataFrame:
    """(class_id, component) of the ranked classes."""
    total = ranked.count()
    homes = ranked.groupBy("home").agg(F.count("*").alias("k"), F.min("class_id").alias("first"))
    homes = homes.select("home", "first", F.ceil(F.col("k") / GROUP).alias("parts"))
    group = lambda part: F.xxhash64("home", part).alias("g")
    members = ranked.join(homes, "home").select(
        group(F.pmod(F.xxhash64("class_id"), F.col("parts"))), "class_id", "n", "tokens", "lead", F.lit(False).alias("pivot"))
    # the first class of a divided home joins every part, so that its near copies link through it
    pivots = ranked.join(homes.filter("parts > 1").drop("home"), F.col("class_id") == F.col("first"))
    pivots = pivots.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    pivots = pivots.filter(F.col("part") != F.pmod(F.xxhash64("class_id"), F.col("parts")))
    pivots = pivots.select(group(F.col("part")), "class_id", "n", "tokens", F.array().cast("array<long>").alias("lead"), F.lit(True).alias("pivot"))

    def link(table: pa.Table) -> pa.Table:
        return _link_members(percent, table)

    def visit(table: pa.Table) -> pa.Table:
        return _visit(percent, table)

    grouped = kept(
        _bins(members.union(pivots), total, "g").applyInArrow(link, "g long, class_id long, n long, tokens binary, lead array<long>, comp long"),
        "groups")
    # only components of several classes need their size: a short list where few are linked
    comps = kept(grouped.groupBy("comp").agg(F.count("*").alias("size")).filter("size > 1"), "sizes")
    lead = grouped.select("g", "class_id", "comp", F.explode("lead").alias("token")).join(comps, "comp", "left")
    lead = kept(lead.select("token", "g", "class_id", F.struct(F.coalesce("size", F.lit(1)).alias("size"), "comp").alias("rank")), "lead")
    # the matrix: tokens that lead sets of different components, and the groups they are in
    open_tokens = lead.groupBy("token").agg(F.min("rank.comp").alias("lo"), F.max("rank.comp").alias("hi")).filter("lo < hi").select("token")
    matrix = lead.groupBy("token", "g").agg(F.max("rank").alias("top")).join(open_tokens, "token", "left_semi")
    asks = lead.join(open_tokens, "token", "left_semi").withColumnRenamed("g", "own")
    # the smaller component asks, so members of a large one never look for stragglers
    visits = kept(
        asks.join(matrix, "token").filter((F.col("rank") < F.col("top")) & (F.col("own") != F.col("g"))).select("class_id", "g").distinct(), "visits")
    slots = visits.groupBy("g").agg(F.ceil(F.count("*") / VISITORS).alias("slots"))
    shape = ["g", "slot", "n", "tokens", "comp", "visits"]
    guests = visits.join(slots, "g").join(grouped.drop("g"), "class_id")
    guests = guests.withColumn("slot", F.pmod(F.xxhash64("class_id"), F.col("slots"))).withColumn("visits", F.lit(True)).select(*shape)
    hosts = grouped.join(slots, "g").withColumn("slot", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1)))
    hosts = hosts.withColumn("visits", F.lit(False)).select(*shape)
    edges = kept(_bins(guests.union(hosts), total, "g", "slot").applyInArrow(visit, "a long, b long"), "links")
    merged = components(edges)
    return grouped.join(merged, F.col("comp") == F.col("node"), "left").select("class_id", F.coalesce("label", "comp").alias("component"))


def ngram_components(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, class_id and component_id.

    Words are lower-cased (A-Z); a set holds the distinct shingles of `width` words, or
    the whole sequence of a shorter text.  Two sets link when 100 * intersection >=
    percent * union.  class_id is the smallest id with the same set, component_id the
    smallest id reachable by links.  A null, empty or blank text has an empty set, links
    with nothing and is its own component.  A null id keeps n_shingles and has null class
    and component, and links nothing.  Repeated rows link with each other.  Ids are
    whole numbers; columns other than the id and the text are ignored."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    layout = tally.Layout.of(docs)
    units = tally.in_units(docs, layout, "doc_id", "text")

    def send(table: pa.Table) -> pa.Table:
        return _send_sets(width, layout, table)

    def describe(table: pa.Table, totals: pa.Table) -> pa.Table:
        return _describe(width, percent, layout, table, totals)

    totals = kept(tally.add_up(units.groupBy("unit").applyInArrow(send, tally.BLOBS), tally.magnitude), "shingles")
    sets = kept(
        units.groupBy("unit").cogroup(totals.groupBy("unit"))
        .applyInArrow(describe, "doc_id long, n_shingles long, sig_a long, sig_b long, tokens binary"), "sets")
    signature = ["n_shingles", "sig_a", "sig_b"]
    classes = kept(
        sets.filter("tokens is not null and doc_id is not null").groupBy(*signature)
        .agg(F.min("doc_id").alias("class_id"), F.min_by("tokens", "doc_id").alias("tokens")), "classes")
    inner = tally.Layout.of(classes, "tokens")

    def send_classes(table: pa.Table) -> pa.Table:
        return _send_classes(inner, table)

    def rank(table: pa.Table, found: pa.Table) -> pa.Table:
        return _rank(percent, inner, table, found)

    dealt = tally.in_units(classes.select("class_id", F.col("n_shingles").alias("n"), "tokens"), inner, "class_id", "tokens")
    again = kept(tally.add_up(dealt.groupBy("unit").applyInArrow(send_classes, tally.BLOBS), tally.magnitude), "tokens")
    ranked = kept(dealt.groupBy("unit").cogroup(again.groupBy("unit")).applyInArrow(rank, _RANKED), "ranked")
    named = classes.drop("tokens").join(_linked_classes(ranked, percent), "class_id", "left")
    named = named.select(*signature, "class_id", F.coalesce("component", "class_id").alias("component"))
    known = F.col("doc_id").isNotNull()
    return sets.drop("tokens").join(named, signature, "left").select(
        "doc_id", "n_shingles", F.when(known, F.coalesce("class_id", "doc_id")).alias("class_id"),
        F.when(known, F.coalesce("component", "doc_id")).alias("component_id"))
