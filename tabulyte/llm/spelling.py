"""Spelling variants: words one edit apart, found in a trie of letter-group counts.

A word's vector says how many of its letters are in each group of letters.  The trie has
the word length as its first level and then a level per group.  One inserted, deleted or
replaced letter changes the vector by at most one surplus and one deficit, so a search
goes down the trie with a budget of one each; the words at a leaf are then compared
letter by letter.

The first levels of the search are dealt over the cluster: a word sends itself, with the
budget it has spent, to every node of a certain depth that it can reach, and the task of a
node searches the levels below, depth first, for all its visitors.  The depth follows from
the measured number of words per node; a node that is still too large is divided, with
visitors copied to every division.  Of two words only one visits the other's node, so each
pair is found once, and what leaves a task is one row per word.

Words are of Latin letters up to U+00FF.  A null text has none; a null id counts as empty
text in the choice of deleted letters; repeated rows count as often as they stand there.
Other columns are left out.  An empty table gives an empty result."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tabulyte.llm.scratch import dropped, kept, partitions
from tabulyte.llm.words import mix

#: Letters from the most to the least frequent, dealt to the groups in turn.
LETTERS = "etaoinshrdlcumwfgypbvkjxqz"
GROUPS = 20
#: The search is dealt over the cluster at this level at most.
DEEPEST = 8
#: Words of a node that one task searches, visitors of a node per task, rows of a shard.
NODE_WORDS, NODE_VISITORS, SHARD_ROWS = 10_000, 200_000, 100_000
LEAST, TWICE, FACTOR, ONE_IN = 7, 2, 10, 31
_SLICE = 1 << 17
_U = np.uint64

GROUP_OF = np.arange(256) % GROUPS
for _i, _c in enumerate(LETTERS):
    GROUP_OF[ord(_c)] = _i % GROUPS

VISIT = "key long, role byte, word string, n long"
FOUND = "word string, n_near long, best_n long, best string"
_VISIT = pa.schema([("key", pa.int64()), ("role", pa.int8()), ("word", pa.string()), ("n", pa.int64())])
_FOUND = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])
#: Roles: a word of the node, or the budget its visitor has spent.
HOST, SURPLUS, DEFICIT, OWN = 0, 1, 2, 4
VISITOR = 8


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """`(word, n)` of the words with at least two occurrences and seven letters, after one
    letter is taken out of a fixed choice of occurrences."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(lower, F.lit(f"[a-zÀ-ÿ]{{{LEAST},}}"), F.lit(0))).alias("run"))
    hashed = runs.select("run", F.crc32(F.encode(F.concat("id", F.lit(":"), "run"), "UTF-8")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    less = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = hashed.select(F.when(F.col("h") % ONE_IN == 0, less).otherwise(F.col("run")).alias("word"))
    counted = words.filter(F.length("word") >= LEAST).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= TWICE)


class _Words:
    """Letters of all words as bytes, one after another."""

    def __init__(self, column: pa.Array):
        self.texts = column
        self.letters = np.frombuffer("".join(column.to_pylist()).encode("latin-1"), np.uint8)
        self.size = pc.utf8_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.place, self.matrix = np.empty(len(self.size), np.int64), {}

    def vectors(self) -> np.ndarray:
        row = np.repeat(np.arange(len(self.size)), self.size)
        flat = np.bincount(row * GROUPS + GROUP_OF[self.letters], minlength=len(self.size) * GROUPS)
        return flat.reshape(-1, GROUPS)

    def rows(self, which: np.ndarray, size: int) -> np.ndarray:
        """Letters of words of one size, a row each."""
        if size not in self.matrix:
            alike = np.flatnonzero(self.size == size)
            self.place[alike] = np.arange(len(alike))
            self.matrix[size] = self.letters[self.start[alike][:, None] + np.arange(size)]
        return self.matrix[size][self.place[which]]


def node_keys(size: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A 64-bit name of the node with this word length and these first counts.  Two nodes
    of one name would only be searched together."""
    key = mix(size.astype(_U))
    for c in counts.T:
        key = mix(key ^ c.astype(_U))
    return key.view(np.int64)


def _steps(depth: int) -> list[tuple[int, np.ndarray, int]]:
    """Nodes of the given depth that a word goes to: change of length, changes of the
    counts, and the budget this spends.  Of two opposite steps only one is in the list."""
    unit = np.eye(depth, dtype=np.int64)
    steps = [(0, np.zeros(depth, np.int64), OWN), (1, np.zeros(depth, np.int64), DEFICIT)]
    steps += [(1, unit[i], SURPLUS | DEFICIT) for i in range(depth)]  # a longer word has no deficit
    for i in range(depth):
        steps.append((0, unit[i], SURPLUS))
        steps += [(0, unit[i] - unit[j], SURPLUS | DEFICIT) for j in range(i + 1, depth)]
    return steps


def _visits(depth: int):
    steps = _steps(depth)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            words = _Words(b.column("word"))
            counts = words.vectors()[:, :depth]
            yield pa.RecordBatch.from_arrays([pa.array(node_keys(words.size, counts)), pa.array(np.full(b.num_rows, HOST, np.int8)), b.column("word"), b.column("n")], schema=_VISIT)
            for longer, change, role in steps:
                to = counts + change
                able = np.flatnonzero((to >= 0).all(1))
                if len(able):
                    keys = node_keys(words.size[able] + longer, to[able])
                    roles = np.full(len(able), VISITOR | role, np.int8)
                    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(roles), b.column("word").take(pa.array(able)), b.column("n").take(pa.array(able))], schema=_VISIT)

    return run


class _Trie:
    """The words of some nodes, ordered by node and further counts.  `child[l]` names each
    node of level l + 1 by its parent and count, in order; `first` is where its words begin."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.order = np.lexsort((*counts.T[::-1], keys))
        keys, counts = keys[self.order], counts[self.order]
        self.width = int(counts.max(initial=0)) + 3
        new = np.concatenate([[True], keys[1:] != keys[:-1]])
        self.roots = keys[new]
        node = np.cumsum(new) - 1
        self.child = []
        for c in counts.T:
            name = node * self.width + c + 1
            new = np.concatenate([[True], name[1:] != name[:-1]])
            self.child.append(name[new])
            node = np.cumsum(new) - 1
        self.first = np.append(np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]])), len(node))

    def search(self, keys: np.ndarray, counts: np.ndarray, roles: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of visitors and words at the leaves within budget, slice by slice."""
        root = np.searchsorted(self.roots, keys)
        there = np.flatnonzero(self.roots[np.minimum(root, len(self.roots) - 1)] == keys)
        stack = [(0, s, root[s], (roles[s] & SURPLUS) > 0, (roles[s] & DEFICIT) > 0) for s in np.array_split(there, len(there) // _SLICE + 1)]
        while stack:
            level, who, node, surplus, deficit = stack.pop()
            if not len(who):
                continue
            if level == len(self.child):
                yield from self._leaf(who, node)
                continue
            below, parts = self.child[level], []
            for change in (-1, 0, 1):
                able = np.flatnonzero(~surplus if change > 0 else ~deficit if change < 0 else np.ones(len(who), bool))
                name = node[able] * self.width + np.clip(counts[who[able], level] + change + 1, 0, self.width - 1)
                at = np.minimum(np.searchsorted(below, name), len(below) - 1)
                hit = below[at] == name
                s = able[hit]
                parts.append((who[s], at[hit], surplus[s] | (change > 0), deficit[s] | (change < 0)))
            joined = [np.concatenate(p) for p in zip(*parts)]
            pieces = len(joined[0]) // _SLICE + 1
            stack += [(level + 1, *p) for p in zip(*[np.array_split(j, pieces) for j in joined])]

    def _leaf(self, who: np.ndarray, node: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        size = self.first[node + 1] - self.first[node]
        ends = np.cumsum(size)
        at = 0
        while at < len(who):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + 4 * _SLICE, side="right")))
            n = size[at:to]
            offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            yield np.repeat(who[at:to], n), self.order[np.repeat(self.first[node[at:to]], n) + offset]
            at = to


def one_edit(a: _Words, i: np.ndarray, b: _Words, j: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Which pairs differ by one letter that b's word replaces or has more; of replaced
    letters with `own` set, only where b's letter is the larger."""
    out = np.zeros(len(i), bool)
    order = np.argsort(b.size[j], kind="stable")
    sizes, first = np.unique(b.size[j][order], return_index=True)
    for size, group in zip(sizes.tolist(), np.split(order, first[1:]) if len(order) else []):
        step = max(1, (8 << 20) // size)
        for at in range(0, len(group), step):
            s = group[at : at + step]
            longer = a.size[i[s]] < size
            same, more = s[~longer], s[longer]
            x, y = a.rows(i[same], size), b.rows(j[same], size)
            differ = x != y
            place = differ.argmax(1)[:, None]
            rising = np.take_along_axis(y, place, 1)[:, 0] > np.take_along_axis(x, place, 1)[:, 0]
            out[same] = (differ.sum(1) == 1) & (rising | ~own[same])
            x, y = a.rows(i[more], size - 1), b.rows(j[more], size)
            before = np.cumprod(x == y[:, :-1], axis=1).sum(1)
            after = np.cumprod((x == y[:, 1:])[:, ::-1], axis=1).sum(1)
            out[more] = before + after >= size - 1
    return out


def _best(texts: pa.Array, n: np.ndarray, me: np.ndarray, other: np.ndarray) -> pa.Table:
    """Per word how many are near and which of them counts most, ties to the smaller word."""
    rank = np.empty(len(texts), np.int64)
    rank[pc.sort_indices(texts).to_numpy()] = np.arange(len(texts))
    order = np.lexsort((rank[other], -n[other], me))
    word, first, count = np.unique(me[order], return_index=True, return_counts=True)
    best = other[order[first]]
    return pa.table([texts.take(pa.array(word)), pa.array(count), pa.array(n[best]), texts.take(pa.array(best))], schema=_FOUND)


def _search(depth: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        role = table.column("role").to_numpy()
        at_home, away = np.flatnonzero(role == HOST), np.flatnonzero(role != HOST)
        if not len(at_home) or not len(away):
            return _FOUND.empty_table()
        column = lambda name, rows: table.column(name).take(pa.array(rows)).combine_chunks()
        hosts, guests = _Words(column("word", at_home)), _Words(column("word", away))
        keys = table.column("key").to_numpy()
        trie = _Trie(keys[at_home], hosts.vectors()[:, depth:])
        left, right, own = [], [], (role[away] & OWN) > 0
        for i, j in trie.search(keys[away], guests.vectors()[:, depth:], role[away]):
            near = one_edit(guests, i, hosts, j, own[i])
            left.append(away[i[near]])
            right.append(at_home[j[near]])
        if not left:
            return _FOUND.empty_table()
        # the same word may stand in several rows: rows of a word are one
        coded = table.column("word").combine_chunks().dictionary_encode()
        index, n = coded.indices.to_numpy(), np.zeros(len(coded.dictionary), np.int64)
        n[index] = table.column("n").to_numpy()
        a, b = index[np.concatenate(left)], index[np.concatenate(right)]
        return _best(coded.dictionary, n, np.concatenate([a, b]), np.concatenate([b, a]))

    return run


def _depth(words: DataFrame) -> int:
    """The least number of counts that leaves no node too large, from the exact sizes of
    the nodes of every depth."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                own = _Words(b.column("word"))
                counts = own.vectors()
                for depth in range(1, DEEPEST + 1):
                    key, n = np.unique(node_keys(own.size, counts[:, :depth]), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), depth, np.int32)), pa.array(key), pa.array(n)], ["depth", "key", "n"])

    nodes = words.select("word").mapInArrow(run, "depth int, key long, n long").groupBy("depth", "key").agg(F.sum("n").alias("n"))
    most = {r["depth"]: r["n"] for r in nodes.groupBy("depth").agg(F.max("n").alias("n")).collect()}
    return next((d for d in sorted(most) if most[d] <= NODE_WORDS), DEEPEST)


def near_words(words: DataFrame, depth: int | None = None) -> DataFrame:
    """`(word, n_near, best_n, best)` of every word of `(word, n)` that has a near one: how
    many there are, and the most frequent of them."""
    depth = depth or _depth(words)
    visits = words.mapInArrow(_visits(depth), VISIT)
    crowded = visits.groupBy("key").agg(F.count(F.when(F.col("role") == HOST, 1)).alias("hosts"), F.count(F.when(F.col("role") != HOST, 1)).alias("guests"))
    crowded = crowded.filter((F.col("hosts") > NODE_WORDS) | (F.col("guests") > NODE_VISITORS) & (F.col("hosts") > 0))
    parts = kept(crowded.select("key", F.ceil(F.col("hosts") / NODE_WORDS).alias("rows"), F.ceil(F.col("guests") / NODE_VISITORS).alias("cols")), "crowded")
    cell = F.struct(F.lit(0).alias("row"), F.lit(0).alias("col"))
    if parts.isEmpty():
        visits = visits.withColumn("cell", cell)
    else:  # a word and a visitor meet in one cell of rows x cols
        mine = lambda n: F.pmod(F.xxhash64("word"), F.col(n)).cast("int")
        all_ = lambda n: F.sequence(F.lit(0), F.col(n).cast("int") - 1)
        cells = F.when(F.col("role") == HOST, F.transform(all_("cols"), lambda c: F.struct(mine("rows").alias("row"), c.alias("col")))).otherwise(
            F.transform(all_("rows"), lambda r: F.struct(r.alias("row"), mine("cols").alias("col"))))
        joined = visits.join(parts.select(F.col("key").alias("_key"), "rows", "cols"), F.col("key") == F.col("_key"), "left")
        visits = joined.withColumn("cell", F.explode(F.when(F.col("rows").isNull(), F.array(cell)).otherwise(cells)))
    total = words.count() * (len(_steps(depth)) + 1)
    shards = max(partitions(words.sparkSession), -(-total // SHARD_ROWS))
    shard = F.pmod(F.xxhash64("key", "cell"), F.lit(shards)).cast("int")
    # a shard may hold several cells of a divided node: the cell is part of the node's name
    named = F.when((F.col("cell.row") == 0) & (F.col("cell.col") == 0), F.col("key")).otherwise(F.xxhash64("key", "cell"))
    found = visits.select(shard.alias("shard"), named.alias("key"), "role", "word", "n").groupBy("shard").applyInArrow(_search(depth), FOUND)
    first = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("b")).select("word", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.word").alias("best"))


def _last(forms: DataFrame) -> DataFrame:
    """`(word, root)`: where the forms of each word end.  Counts rise tenfold with each
    form, so a chain is short and doubling its steps ends after a few rounds."""
    links = kept(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        step = links.select(F.col("word").alias("at"), F.col("root").alias("next"))
        on = links.join(step, F.col("root") == F.col("at"), "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("went"))
        on = kept(on, "forms")
        dropped(links)
        links = on.drop("went")
        if on.filter("went").isEmpty():
            return links


def spelling_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text", factor: int = FACTOR) -> DataFrame:
    """`(word, form, root, n, n_near, form_n)`: a word's form is its most frequent near
    word, if that is `factor` times as frequent; the root is where its forms end."""
    words = kept(vocabulary(docs, id_col, text), "vocabulary")
    near = near_words(words)
    likely = F.col("best_n") >= factor * F.col("n")
    placed = kept(
        words.join(near, "word", "left").select(
            "word", F.when(likely, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(likely, F.col("best_n")).alias("form_n")), "near")
    roots = _last(placed.filter("form is not null").select("word", "form"))
    return placed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
