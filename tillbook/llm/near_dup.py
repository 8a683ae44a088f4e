"""MinHash near-duplicates by an inverted join over signature coordinates.

Each distinct shingle set gets a MinHash signature. The first ``POSTED`` coordinates are inverted: a
document is posted under each (coordinate, value). Two documents whose sets are similar enough agree in
at least ``MATCHES`` posted coordinates but for a chance below 1e-5, so by the prefix rule they meet in a
posting of one of their POSTED - MATCHES + 1 rarest values; postings outside that prefix are skipped,
and postings of one document vanish before anything is joined. Documents that meet are compared by whole
signatures, and what passes is confirmed on whole shingle sets.

Only connected components are asked for, so pairs inside what is connected already are never made:
first every document is confirmed against the leader it shares most postings with, then only postings
that still span several components compare their members, component against component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tillbook.llm.common import components, grouped, measured_broadcasts, merged, mix, rows, runs, save, small_batches, word_hashes

WIDTH = 5  # words in a shingle
PERCENT = 75  # similarity from which documents are linked
COORDINATES = 1024  # length of a signature
POSTED = 32  # coordinates that are inverted
MATCHES = 12  # least matches among the posted ones: five deviations below the mean at the threshold
# Two bits of a coordinate are compared, so a quarter of the unequal ones match by chance; the least matches lie
# five deviations below the mean at the threshold, first in the leading coordinates, then in all.
GLANCE, GLANCED = 256, 176
AGREED = 767
_BLOCK_WORDS = 50_000
_BLOCK_MEMBERS = 4_096
_EQUAL = np.array([sum((x >> k) & 3 == 0 for k in (0, 2, 4, 6)) for x in range(256)], np.uint8)  # of four coordinates

_SEEDS = np.random.default_rng(20240501)
_MULTIPLY = _SEEDS.integers(0, 2**32, COORDINATES, dtype=np.uint32) | np.uint32(1)
_ADD = _SEEDS.integers(0, 2**32, COORDINATES, dtype=np.uint32)


def shingles(hashes: np.ndarray) -> np.ndarray:
    """Sorted distinct shingles of one document from its word hashes."""
    if 0 < len(hashes) < WIDTH:
        return mix(runs(hashes, len(hashes)) + np.uint64(len(hashes)))
    found = np.sort(runs(hashes, WIDTH))
    return found[np.concatenate([[True], found[1:] != found[:-1]])] if len(found) else found


def _sets(records: list[tuple]) -> list[np.ndarray]:
    hashes, counts = word_hashes([record[1] or b"" for record in records], lower=True)
    return [shingles(part) for part in np.split(hashes, np.cumsum(counts)[:-1])]


def _weight(record: tuple) -> int:
    return len(record[1] or b"") // 6 + 1


def _signatures(sets: list[np.ndarray], length: int) -> np.ndarray:
    """One row of minima per set; no set is empty."""
    values = np.concatenate(sets).astype(np.uint32)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    out, mixed = np.empty((length, len(sets)), np.uint32), np.empty_like(values)
    for k in range(length):
        np.multiply(values, _MULTIPLY[k], out=mixed)
        np.add(mixed, _ADD[k], out=mixed)
        np.minimum.reduceat(mixed, starts, out=out[k])
    return np.ascontiguousarray(out.T)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in grouped(rows(batches), _weight, _BLOCK_WORDS):
        sets = _sets(part)
        full = [k for k, s in enumerate(sets) if len(s)]
        signed = dict(zip(full, _signatures([sets[k] for k in full], POSTED))) if full else {}
        yield pa.RecordBatch.from_pydict({
            "doc_id": pa.array([r[0] for r in part], pa.int64()),
            "tag": pa.array([r[2] for r in part], pa.int64()),
            "n": pa.array([len(s) for s in sets], pa.int64()),
            "mark": pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
            "posted": pa.array([signed[k].view(np.int32) if k in signed else None for k in range(len(part))], pa.list_(pa.int32())),
        })


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in grouped(rows(batches), _weight, _BLOCK_WORDS):
        sets = _sets(part)
        part, sets = [r for r, s in zip(part, sets) if len(s)], [s for s in sets if len(s)]
        if sets:
            bits = ((_signatures(sets, COORDINATES) >> np.uint32(11)) & np.uint32(3)).astype(np.uint8).reshape(len(sets), -1, 4)
            brief = bits[:, :, 0] | bits[:, :, 1] << 2 | bits[:, :, 2] << 4 | bits[:, :, 3] << 6
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array([r[0] for r in part], pa.int64()), "n": pa.array([len(s) for s in sets], pa.int64()),
                "tokens": pa.array([r[2] for r in part], pa.list_(pa.int64())),
                "brief": pa.array([b.tobytes() for b in brief], pa.binary()), "whole": pa.array([s.tobytes() for s in sets], pa.binary()),
            })


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = []
        for u, v, one, other in rows(iter([batch])):
            a, b = np.frombuffer(one, np.uint64), np.frombuffer(other, np.uint64)
            common = len(np.intersect1d(a, b, assume_unique=True))
            if 100 * common >= PERCENT * (len(a) + len(b) - common):
                kept.append((u, v))
        yield pa.RecordBatch.from_pydict({
            "u": pa.array([p[0] for p in kept], pa.int64()), "v": pa.array([p[1] for p in kept], pa.int64()),
        })


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The components (u, v) of the documents (one, other) whose whole sets are similar enough. A document in many
    pairs is split by the adaptive join."""
    one = sets.select(F.col("doc_id").alias("one"), F.col("whole").alias("whole"))
    other = sets.select(F.col("doc_id").alias("other"), F.col("whole").alias("beside"))
    return pairs.join(one, "one").join(other, "other").select("u", "v", "whole", "beside").mapInArrow(_confirm, "u long, v long")


def _matches(many: np.ndarray, one: np.ndarray) -> np.ndarray:
    return np.take(_EQUAL, many ^ one).sum(axis=1, dtype=np.int32)


def _across(rows: pa.Table, every: bool) -> pa.Table:
    """Pairs of a probe and a member from different components whose signatures and sizes allow a link.

    A pair is made in the first posting that its two prefixes share and nowhere else. Unless ``every`` pair is
    asked for, only the likeliest one of two components is returned.
    """
    sides = [rows.filter(pc.field("probe")), rows.filter(~pc.field("probe"))]
    if not all(t.num_rows for t in sides):
        return _pairs(*np.empty((4, 0), np.int64))
    probe, member = ({c: t[c].to_numpy() for c in ("doc_id", "n", "component")} for t in sides)
    views = [np.frombuffer(b"".join(t["brief"].to_pylist()), np.uint8).reshape(-1, COORDINATES // 4) for t in sides]
    leading = np.ascontiguousarray(views[1][:, : GLANCE // 4])
    prefixes = [t["tokens"].to_pylist() for t in sides]
    here = rows["token"][0].as_py()
    found: list[tuple] = []
    for k in range(len(views[0])):
        n, m = probe["n"][k], member["n"]
        able = (member["component"] != probe["component"][k]) & (100 * np.minimum(n, m) >= PERCENT * np.maximum(n, m))
        able = np.flatnonzero(able)
        able = able[_matches(leading[able], views[0][k, : GLANCE // 4]) >= GLANCED]
        agreed = _matches(views[1][able], views[0][k])
        hit = np.flatnonzero(agreed >= AGREED)
        able, agreed = able[hit], agreed[hit]
        if every:
            own = set(prefixes[0][k])
            first = [min(own.intersection(prefixes[1][t])) == here for t in able]
            able, agreed = able[first], agreed[first]
        else:  # the likeliest of each component
            order = np.lexsort((-agreed, member["component"][able]))
            lead = np.concatenate([[True], np.diff(member["component"][able[order]]) != 0])[: len(order)]
            able, agreed = able[order[lead]], agreed[order[lead]]
        found.append((np.full(len(able), k), able, agreed))
    if not found:
        return _pairs(*np.empty((4, 0), np.int64))
    left, right, agreed = (np.concatenate(c) for c in zip(*found))
    one, other = probe["doc_id"][left], member["doc_id"][right]
    u, v = probe["component"][left], member["component"][right]
    if not every:
        parts = np.sort([u, v], axis=0)
        order = np.lexsort((-agreed, parts[1], parts[0]))
        lead = order[np.concatenate([[True], (np.diff(parts[:, order]) != 0).any(axis=0)])[: len(order)]]
        one, other, u, v = one[lead], other[lead], u[lead], v[lead]
    turned = one > other
    return _pairs(*(np.where(turned, b, a) for a, b in ((one, other), (other, one), (u, v), (v, u))))


def _pairs(one: np.ndarray, other: np.ndarray, u: np.ndarray, v: np.ndarray) -> pa.Table:
    return pa.table({name: pa.array(x, pa.int64()) for name, x in (("one", one), ("other", other), ("u", u), ("v", v))})


def _dealt(prefix: DataFrame, labelled: DataFrame) -> DataFrame:
    """Postings that hold several components, where all but the largest part probe all members: (token, band, block,
    turn, doc_id, component, probe), so that each block of members meets each turn of probes and neither grows with the posting.

    Postings longer than a block are first dealt into bands of sizes a third apart; a probe asks its own band and
    the two beside it, as no link reaches further.
    """
    sized = prefix.select("doc_id", "token", "held").join(labelled.select("doc_id", "n", "component"), "doc_id")
    band = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / PERCENT)).cast("int")
    members = sized.select("doc_id", "token", "component", F.when(F.col("held") > _BLOCK_MEMBERS, band).alias("band"))
    parts = members.groupBy("token", "component").agg(F.count("*").alias("size"))
    split = (
        parts.groupBy("token")
        .agg(F.max(F.struct("size", "component")).alias("main"), F.count("*").alias("parts"))
        .filter("parts > 1")
        .select("token", F.col("main.component").alias("main"))
    )
    opened = save(members.join(split, "token"), "open")

    def at(probe: bool, band: Column) -> Column:
        return F.struct(F.lit(probe).alias("probe"), band.alias("band"))

    lone = F.coalesce("band", F.lit(0))
    asked = F.when(F.col("band").isNull(), F.array(at(True, F.lit(0)))).otherwise(F.array(*(at(True, lone + k) for k in (-1, 0, 1))))
    places = F.when(F.col("component") == F.col("main"), F.array(at(False, lone))).otherwise(F.concat(F.array(at(False, lone)), asked))
    both = opened.select("token", "doc_id", "component", F.explode(places).alias("at")).select("token", "doc_id", "component", "at.*")
    cells = both.groupBy("token", "band").agg(
        F.ceil(F.count_if(~F.col("probe")) / _BLOCK_MEMBERS).cast("int").alias("blocks"),
        F.ceil(F.count_if("probe") / _BLOCK_MEMBERS).cast("int").alias("turns"),
    ).filter("blocks > 0 AND turns > 0")

    def own(count: str) -> Column:
        return F.array(F.pmod(F.xxhash64("doc_id"), F.col(count)).cast("int"))

    def every(count: str) -> Column:
        return F.sequence(F.lit(0), F.col(count) - 1)

    return (
        both.join(cells, ["token", "band"])
        .withColumn("block", F.explode(F.when(F.col("probe"), every("blocks")).otherwise(own("blocks"))))
        .withColumn("turn", F.explode(F.when(F.col("probe"), own("turns")).otherwise(every("turns"))))
        .select("token", "band", "block", "turn", "doc_id", "component", "probe")
    )


def _open_pairs(prefix: DataFrame, labelled: DataFrame, briefs: DataFrame, every: bool) -> DataFrame:
    """Pairs (one, other) across the components (u, v) of a posting."""
    both = _dealt(prefix, labelled).join(briefs, "doc_id")

    def across(rows: pa.Table) -> pa.Table:
        return _across(rows, every)

    return both.groupBy("token", "band", "block", "turn").applyInArrow(across, "one long, other long, u long, v long").distinct()


def _roots(links: DataFrame) -> DataFrame:
    """(node, component) of links (u, v) in which u < v and no v has two: pointers jump until they end at a root,
    in rounds that grow with the logarithm of the longest path."""
    found = links.select(F.col("v").alias("node"), F.col("u").alias("component"))
    while True:
        above = found.select(F.col("node").alias("component"), F.col("component").alias("above"))
        found = found.join(above, "component", "left").select(
            "node", F.coalesce("above", "component").alias("component"), F.col("above").isNotNull().alias("moved")
        )
        found = save(found, "roots")
        if not found.agg(F.max("moved")).first()[0]:
            return found.select("node", "component")


def _merged(labelled: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after links (u, v) between components."""
    if links.isEmpty():
        return labelled
    found = components(links).select(F.col("node").alias("component"), F.col("component").alias("to"))
    joined = labelled.join(found, "component", "left").select("doc_id", "n", F.coalesce("to", "component").alias("component"))
    return save(joined, "labelled")


def near_duplicates(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", tag: Column | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest linked doc_id) and kept, a row for each row of ``documents``.

    Null and empty texts have no shingles and are linked with nothing. Rows without an id are never linked:
    their component is null and they are kept. Rows that share an id are one document. Other columns are
    ignored, whatever their names; an empty table gives an empty result. With a ``tag`` (a number made from a row)
    it is returned too, to tell rows that share an id.
    """
    own_tag = (F.lit(None) if tag is None else tag).cast("long").alias("tag")
    source = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"), own_tag)
    with small_batches(documents.sparkSession), measured_broadcasts(documents.sparkSession):
        described, label = _described_and_labelled(source)
    linked = described.select("doc_id", "tag", "n", F.when(F.col("doc_id").isNotNull(), F.col("mark")).alias("mark")).join(label.hint("merge"), "mark", "left")
    result = linked.select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"), "tag"
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    return result.drop("tag") if tag is None else result


def _described_and_labelled(source: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The size and mark of the set of each row, and the component of each mark; all Python work is done and written."""
    described = save(merged(source.mapInArrow(_describe, "doc_id long, tag long, n long, mark binary, posted array<int>")), "described")

    # One document of each distinct set stands for its copies.
    named = described.filter("n > 0 AND doc_id IS NOT NULL")
    classes = named.groupBy("mark").agg(F.min(F.struct("doc_id", "posted")).alias("least")).select("mark", "least.*")
    classes = save(merged(classes), "classes")

    posted = classes.select("doc_id", F.posexplode("posted").alias("k", "value")).select(
        "doc_id", (F.col("k") * F.lit(2**33) + F.col("value")).alias("token")
    )
    shared = posted.groupBy("token").agg(F.count("*").alias("held")).filter("held > 1")
    # Of each document its postings with the rarest first; all but the last MATCHES - 1 are its prefix.
    ranked = posted.join(shared, "token").groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("held", "token"))).alias("ranked"))
    able = ranked.filter(F.size("ranked") >= MATCHES).select("doc_id", F.slice("ranked", 1, F.size("ranked") - (MATCHES - 1)).alias("ranked"))
    able = save(merged(able), "able")
    prefix = able.select("doc_id", F.explode("ranked").alias("posting")).select("doc_id", "posting.token", "posting.held")
    tokens = able.select("doc_id", F.col("ranked.token").alias("tokens"))
    texts = source.drop("tag").join(tokens, "doc_id").distinct()  # where the join has put them
    sets = save(merged(texts.mapInArrow(_full_sets, "doc_id long, n long, tokens array<long>, brief binary, whole binary")), "sets")
    briefs = sets.select("doc_id", "n", "brief", "tokens")

    # Each document against the leader of its postings that it collides with most often.
    leaders = prefix.groupBy("token").agg(F.min("doc_id").alias("one"))
    collisions = (
        prefix.join(leaders, "token").filter("one <> doc_id")
        .groupBy("one", F.col("doc_id").alias("other")).agg(F.count("*").alias("n"))
    )
    best = collisions.groupBy("other").agg(F.max(F.struct("n", -F.col("one"))).alias("top")).select((-F.col("top.col2")).alias("one"), "other")
    links = save(_confirmed(best.withColumns({"u": F.col("one"), "v": F.col("other")}), sets).distinct(), "links")
    labelled = sets.select("doc_id", "n").join(_roots(links).withColumnRenamed("node", "doc_id"), "doc_id", "left")
    labelled = save(labelled.withColumn("component", F.coalesce("component", "doc_id")), "labelled")

    # What postings still hold apart: the likeliest pair of two components, then every pair that is left.
    for every in (False, True):
        links = save(_confirmed(_open_pairs(prefix, labelled, briefs, every), sets), "links")
        labelled = _merged(labelled, links)
    found = labelled.select("doc_id", "component").distinct()
    label = classes.select("doc_id", "mark").join(found, "doc_id", "left").select("mark", F.coalesce("component", "doc_id").alias("component"))
    return described, save(merged(label), "label")
