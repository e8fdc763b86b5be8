"""Near-duplicate documents by the Jaccard similarity of their word shingles.

Method: chosen-path set similarity join. Documents of equal shingle sets form one
class first. Then every class walks down a number of independent trees: at a node
it picks the smallest of its shingles under the node's own hash and goes to the
child of that shingle, so two sets of similarity J stay together with probability
J at each step. A node with few members is not branched further, and a node with
one member is dropped. The number of trees follows from the similarity, the depth
and the wanted recall of a single link: a pair is missed with probability
``(1 - J ** depth) ** trees`` at most, and far less where nodes get small early.

Nodes are compared in two rounds. First every member meets the smallest id of its
node, and confirmed links are joined to components. Only where members of a node
are still in different components are they compared across them: as pairs in
small nodes, and in large ones by blocks of sets against chunks of sets inside a
task. So a large group of near copies costs one comparison for each member that
is like the first, no pairs are made within it, and no link between different
components is passed over. Links are confirmed on the full sets of 64-bit shingle
hashes of both texts.

Spark deals out nodes and pairs by joins on equality; smallest ids and sizes are
aggregates that are joined back, so no node is gathered in one task and hot ones
are split by adaptive execution. Intermediate tables are stored in the shared
folder.

Texts are lower-cased (A-Z). With fewer than five words the whole sequence is the
only shingle; null and empty texts have none and are linked with nothing. Rows
with equal id and text count as one document; rows that share an id only, and rows
without one, are documents of their own. A null id names a component only where no
member has an id. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerleaf.llm.common import by_size, own_rows, plain_names
from ledgerleaf.llm.components import connected_components
from ledgerleaf.llm.shingles import RunHashes, WordHashes, mix
from ledgerleaf.scratch import passing_tables, settle, settle_outside

SHINGLE = 5
BLOCK = 2048
SMALL_NODE = 32
BLOCK_DOCS, CHUNK_DOCS = 256, 1024
CELLS = 1 << 24


@dataclass(frozen=True)
class SimilarityJoin:
    """``percent`` is the least similarity, ``small`` the size of a node that is not branched."""

    percent: int = 80
    depth: int = 4
    small: int = 16
    recall: float = 0.9999999
    seed: int = 20

    @property
    def trees(self) -> int:
        together = (self.percent / 100) ** self.depth
        return math.ceil(math.log(1 - self.recall) / math.log(1 - together))


def _sets(texts: list[str | None], hashes: WordHashes) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words = [
        hashes.of(t.encode("utf-8", "surrogatepass").lower().split())
        if t
        else np.empty(0, np.uint64)
        for t in texts
    ]
    sizes = np.array([len(w) for w in words], np.int64)
    if not sizes.sum():
        return words
    runs = RunHashes(np.concatenate(words))
    begin = np.cumsum(sizes) - sizes
    found = []
    for first, size in zip(begin, sizes, strict=True):
        width = min(SHINGLE, size)
        starts = np.arange(first, first + size - width + 1) if size else np.empty(0, np.int64)
        found.append(np.unique(runs.of(starts, int(width))))
    return found


def _smallest(tokens: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """For each seed, the token whose hash under the seed is smallest."""
    best = best_token = None
    for at in range(0, len(tokens), BLOCK):
        block = tokens[at : at + BLOCK]
        hashed = mix(block[None, :] ^ seeds[:, None])
        place = hashed.argmin(1)
        low, token = hashed[np.arange(len(seeds)), place], block[place]
        if best is None:
            best, best_token = low, token
        else:
            better = low < best
            best, best_token = np.where(better, low, best), np.where(better, token, best_token)
    return best_token


def _walk(tokens: np.ndarray, join: SimilarityJoin) -> np.ndarray:
    """Node ids of a set, for each tree (row) and depth (column)."""
    node = mix(np.arange(1, join.trees + 1, dtype=np.uint64) + np.uint64(join.seed << 32))
    path = np.empty((join.trees, join.depth), np.uint64)
    for level in range(join.depth):
        node = mix(node ^ mix(_smallest(tokens, node) + np.uint64(level + 1)))
        path[:, level] = node
    return path


def signatures(docs: DataFrame, join: SimilarityJoin, key: str, text: str) -> DataFrame:
    """doc, n (size of the set), d1 and d2 (digest of the set), paths (trees x depth nodes)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in by_size(batches, "text"):
            sizes, digests, paths = [], [], []
            for own in _sets(batch.column(1).to_pylist(), hashes):
                sizes.append(len(own))
                with np.errstate(over="ignore"):
                    digests.append((mix(own).sum(), mix(own ^ np.uint64(join.seed)).sum()))
                paths.append(_walk(own, join).ravel() if len(own) else np.empty(0, np.uint64))
            offsets = np.r_[0, np.cumsum([len(p) for p in paths])]
            flat = np.concatenate(paths).view(np.int64) if paths else np.empty(0, np.int64)
            pairs = np.array(digests, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(pairs[:, 0]),
                    pa.array(pairs[:, 1]),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat)),
                ],
                ["doc", "n", "d1", "d2", "paths"],
            )

    rows = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(sign, "doc long, n long, d1 long, d2 long, paths array<long>")


def _members(reps: DataFrame, join: SimilarityJoin) -> DataFrame:
    """(node, doc, n): where each class stops in each tree, without nodes of one member."""
    tree = F.explode(F.sequence(F.lit(0), F.lit(join.trees - 1)))
    left = reps.select("doc", "n", "paths", tree.alias("tree")).select(
        "doc", "n", F.slice("paths", F.col("tree") * join.depth + 1, join.depth).alias("path")
    )
    parts = []
    for level in range(join.depth):
        node = F.col("path")[level]
        sizes = left.groupBy(node.alias("node")).agg(F.count("*").alias("size")).where("size > 1")
        sized = settle(left.withColumn("node", node).join(sizes, "node"), "nodes")
        if level + 1 == join.depth:
            parts.append(sized)
            break
        parts.append(sized.where(F.col("size") <= join.small))
        left = sized.where(F.col("size") > join.small).drop("node", "size")
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found.select("node", "doc", "n").distinct()


def _alike_sizes(join: SimilarityJoin):
    """Sets whose sizes differ too much cannot be similar enough."""
    return 100 * F.least("na", "nb") >= join.percent * F.greatest("na", "nb")


def confirm(pairs: DataFrame, docs: DataFrame, join: SimilarityJoin, key: str, text: str) -> DataFrame:
    """The pairs (a, b) whose texts are similar enough, on their full sets."""
    texts = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).cast("string").alias("text"))
    left = pairs.join(texts, F.col("a") == F.col("doc")).select("a", "b", F.col("text").alias("ta"))
    both = left.join(texts, F.col("b") == F.col("doc")).select("a", "b", "ta", F.col("text").alias("tb"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in by_size(batches, "ta"):
            first = _sets(batch.column(2).to_pylist(), hashes)
            second = _sets(batch.column(3).to_pylist(), hashes)
            good = []
            for x, y in zip(first, second, strict=True):
                shared = len(np.intersect1d(x, y, assume_unique=True))
                union = len(x) + len(y) - shared
                good.append(shared > 0 and 100 * shared >= join.percent * union)
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return both.mapInArrow(check, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    join: SimilarityJoin = SimilarityJoin(),
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row for each document: key, n_shingles, component_id, n_links and kept.

    ``component_id`` is the smallest id that links reach, ``n_links`` the number
    of confirmed comparisons of the document's class. ``kept`` is true for the
    document that names the component; where no id is in it, for the first row.
    """
    rows, numbered = own_rows(docs, key, text, share=True)
    found = _linked_rows(rows, join, "_row", text)
    kept = F.col("_row").eqNullSafe(F.col("component_id"))
    kind = docs.schema[key].dataType
    if not numbered:
        return found.select(
            F.col("_row").cast(kind).alias(key),
            "n_shingles",
            F.col("component_id").cast(kind).alias("component_id"),
            "n_links",
            kept.alias("kept"),
        )
    found = settle(found.withColumn("kept", kept), "found")
    names = rows.select("_row", F.col(key).alias("_name")).distinct()
    components = names.select(
        F.col("_row").alias("component_id"), F.col("_name").alias("_component")
    )
    return (
        found.join(names, "_row")
        .join(components, "component_id")
        .select(
            F.col("_name").alias(key),
            "n_shingles",
            F.col("_component").alias("component_id"),
            "n_links",
            "kept",
        )
    )


def _linked_rows(docs: DataFrame, join: SimilarityJoin, key: str, text: str) -> DataFrame:
    """key, n_shingles, component_id and n_links of documents that ``key`` tells apart."""
    signed = settle(signatures(docs, join, key, text), "signatures")
    digest = ["n", "d1", "d2"]
    classes = signed.where("n > 0").groupBy(*digest).agg(F.min("doc").alias("rep"))
    classes = settle(classes, "classes")
    named = classes.where("rep is not null")
    reps = signed.join(
        named.select("n", "d1", "d2", F.col("rep").alias("doc")), [*digest, "doc"], "left_semi"
    )
    members = settle(_members(reps, join), "members")
    pivots = members.groupBy("node").agg(F.min("doc").alias("pivot"))
    pivot_sizes = members.select("node", F.col("doc").alias("pivot"), F.col("n").alias("na"))
    stars = (
        members.join(pivots.join(pivot_sizes, ["node", "pivot"]), "node")
        .where("doc <> pivot")
        .select(F.col("pivot").alias("a"), F.col("doc").alias("b"), "na", F.col("n").alias("nb"))
        .where(_alike_sizes(join))
        .select("a", "b")
        .distinct()
    )
    tried = settle(stars, "stars")
    links = settle(confirm(tried, docs, join, key, text), "links")
    parts = settle(connected_components(links), "components")

    mixed = _mixed(members, parts)
    few, many = mixed.where(F.col("size") <= SMALL_NODE), mixed.where(F.col("size") > SMALL_NODE)
    rest = settle(_across(few, join).join(tried, ["a", "b"], "left_anti"), "rest")
    more = []
    if not rest.isEmpty():
        more.append(confirm(rest, docs, join, key, text))
    if not many.isEmpty():
        more.append(_links_in_blocks(many, docs, join, key, text))
    if more:
        found = more[0] if len(more) == 1 else more[0].unionByName(more[1])
        links = links.unionByName(settle(found, "links")).distinct()
        parts = settle(connected_components(links), "components")

    ends = links.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep")
    counts = ends.agg(F.count("*").alias("n_links"))
    groups = classes.join(parts.withColumnRenamed("node", "rep"), "rep", "left").join(
        counts, "rep", "left"
    )
    result = signed.select("doc", *digest).join(
        groups.select(
            *digest,
            F.coalesce("component", "rep").alias("component"),
            F.coalesce("n_links", F.lit(0)).alias("links"),
        ),
        digest,
        "left",
    )
    kind = docs.schema[key].dataType
    return result.select(
        F.col("doc").cast(kind).alias(key),
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "doc").cast(kind).alias("component_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
    )


def _mixed(members: DataFrame, parts: DataFrame) -> DataFrame:
    """Members of nodes that still hold several components.

    (node, doc, n, part, main: the most frequent component, size and rest: how
    many members the node has, and how many are outside of ``main``).
    """
    placed = members.join(parts.withColumnRenamed("node", "doc"), "doc", "left").select(
        "node", "doc", "n", F.coalesce("component", "doc").alias("part")
    )
    counts = placed.groupBy("node", "part").agg(F.count("*").alias("size"))
    main = counts.groupBy("node").agg(
        F.max_by("part", F.struct("size", "part")).alias("main"),
        F.count("*").alias("parts"),
        F.sum("size").alias("size"),
        (F.sum("size") - F.max("size")).alias("rest"),
    )
    return settle(placed.join(main.where("parts > 1").drop("parts"), "node"), "mixed")


def _across(mixed: DataFrame, join: SimilarityJoin) -> DataFrame:
    """Pairs across components in small nodes; few for each member."""
    x = mixed.select("node", F.col("doc").alias("x"), F.col("n").alias("nx"), F.col("part").alias("px"))
    met = x.join(mixed, "node").where("x < doc and px <> part")
    return (
        met.select(
            F.col("x").alias("a"), F.col("doc").alias("b"), F.col("nx").alias("na"), F.col("n").alias("nb")
        )
        .where(_alike_sizes(join))
        .select("a", "b")
        .distinct()
    )


def _links_in_blocks(
    mixed: DataFrame, docs: DataFrame, join: SimilarityJoin, key: str, text: str
) -> DataFrame:
    """Links (a, b) across components in large nodes.

    Members outside of a node's main component are compared with all members,
    a block of the ones with a chunk of the others at a time, on full sets. Only
    links become rows.
    """
    needed = mixed.select("doc").distinct()
    texts = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).cast("string").alias("text"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in by_size(batches, "text"):
            found = _sets(batch.column(1).to_pylist(), hashes)
            offsets = pa.array(np.r_[0, np.cumsum([len(f) for f in found])], pa.int32())
            flat = pa.array(np.concatenate(found).view(np.int64))
            lists = pa.ListArray.from_arrays(offsets, flat)
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["doc", "tokens"])

    chosen = texts.join(needed, "doc", "left_semi").mapInArrow(sets, "doc long, tokens array<long>")
    chosen = settle(chosen, "sets")
    blocks, chunks = F.ceil(F.col("rest") / BLOCK_DOCS), F.ceil(F.col("size") / CHUNK_DOCS)
    dealt = mixed.withColumn("blocks", blocks).withColumn("chunks", chunks)
    every_chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))
    every_block = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    left = (
        dealt.where("part <> main")
        .withColumn("block", F.pmod(F.xxhash64("doc"), "blocks"))
        .withColumn("chunk", every_chunk)
    )
    right = dealt.withColumn("chunk", F.pmod(F.xxhash64("doc", F.lit(1)), "chunks")).withColumn(
        "block", every_block
    )
    by = ["node", "block", "chunk"]
    columns = [*by, "doc", "part", "tokens"]
    left, right = (side.join(chosen, "doc").select(*columns) for side in (left, right))
    right = right.select(*[F.col(c).alias(f"other_{c}") for c in columns])

    def compare(x: pa.Table, y: pa.Table) -> pa.Table:
        pairs = [np.empty((0, 2), np.int64)]
        if x.num_rows and y.num_rows:
            dx, dy = x["doc"].to_numpy(), y["other_doc"].to_numpy()
            px, py = x["part"].to_numpy(), y["other_part"].to_numpy()
            sets = _ragged(x["tokens"]), _ragged(y["other_tokens"])
            for i, j in linked_sets(*sets, join.percent):
                across = px[i] != py[j]
                pairs.append(np.stack([dx[i][across], dy[j][across]], 1))
        found = np.concatenate(pairs)
        return pa.table({"a": found.min(1, initial=1 << 62), "b": found.max(1, initial=-(1 << 62))})

    others = right.groupBy(*[f"other_{c}" for c in by])
    return left.groupBy(*by).cogroup(others).applyInArrow(compare, "a long, b long").distinct()


def _ragged(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a column of lists."""
    lists = column.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    sizes = np.diff(lists.offsets.to_numpy())
    return lists.flatten().to_numpy(), np.r_[0, np.cumsum(sizes)]


def linked_sets(x, y, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j) of sets of ``x`` and ``y`` that are similar enough, a part at a time."""
    (vx, ox), (vy, oy) = x, y
    nx, ny = np.diff(ox), np.diff(oy)
    known = np.unique(vx)
    place = np.minimum(np.searchsorted(known, vy), len(known) - 1)
    hit = known[place] == vy
    owner = np.repeat(np.arange(len(ny)), ny)[hit]
    place = place[hit]
    rows = max(1, CELLS // max(1, len(known), len(place)))
    for first in range(0, len(nx), rows):
        some = np.arange(first, min(len(nx), first + rows))
        table = np.zeros((len(some), len(known)), np.uint8)
        own = np.repeat(some - first, nx[some])
        table[own, np.searchsorted(known, vx[ox[first] : ox[some[-1] + 1]])] = 1
        shared = np.zeros((len(some), len(ny)), np.int64)
        if len(place):
            starts = np.flatnonzero(np.r_[True, np.diff(owner) != 0])
            counts = np.add.reduceat(table[:, place], starts, axis=1, dtype=np.int64)
            shared[:, owner[starts]] = counts
        union = nx[some][:, None] + ny[None, :] - shared
        i, j = np.nonzero((shared > 0) & (100 * shared >= percent * union))
        yield some[i], j


def keep_one(docs: DataFrame, join: SimilarityJoin = SimilarityJoin()) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, any others) without near duplicates.

    The smallest id of a component stays, and one row of those that repeat it, id and
    text. Rows without an id come after all others, each as a document of its own. Other
    columns come back as they are, whatever their names.
    """
    plain, back = plain_names(docs, ("doc_id", "text"))
    rows, numbered = own_rows(plain, "doc_id", "text", share=True)
    with passing_tables(docs.sparkSession):
        found = _linked_rows(rows, join, "_row", "text")
        gone = settle_outside(found.where("_row <> component_id").select("_row").distinct(), "gone")
    kept = rows.join(gone, "_row", "left_anti")
    if not numbered:
        return kept.select(*back)
    number = F.row_number().over(Window.partitionBy("_row").orderBy(F.xxhash64("text")))
    return kept.withColumn("_number", number).where("_number = 1").select(*back)
