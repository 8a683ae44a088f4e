import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from oracle import assert_same

from tillbook.llm import registry, repeats

SCHEMA = "doc_id long, text string, spans int, s string, order_id long, many int"
LAST = float("inf")


def brute_force(rows):
    texts = [(LAST if i is None else i, (t or "").encode()) for i, t in rows]
    least = {}
    for i, t in texts:
        for p in range(len(t) - 49):
            w = t[p : p + 50]
            least[w] = min(least.get(w, LAST), i)
    out = []
    for (i, t), (own, _) in zip(texts, rows):
        gone = np.zeros(len(t) + 1, bool)
        for p in range(len(t) - 49):
            if least[t[p : p + 50]] < i:
                gone[p : p + 50] = True
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((own, len(t), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum() + gone[0]), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def check(spark, rows):
    frame = spark.createDataFrame([(i, t, 1, "x", 2, 3) for i, t in rows], SCHEMA).repartition(3)
    got = sorted(map(tuple, repeats.digests(frame).collect()), key=repr)
    assert got == brute_force(rows)
    return got


def prose(r, n, words):
    return " ".join(r.choice(words) for _ in range(n))


@pytest.mark.parametrize("chunk, many", [(1 << 21, 4096), (400, 4096), (1 << 21, 2), (3000, 2)])
def test_equals_brute_force(spark, monkeypatch, chunk, many):
    """Passages cut out of one another, with common words, in chunks of one and of many documents."""
    r = random.Random(7)
    words = [f"{r.choice('abcdefg')}{r.choice('hijkl')}{k % 7}" for k in range(30)]
    pool = [prose(r, 60, words) for _ in range(4)]
    rows = []
    for k in range(120):
        a = r.choice(pool)
        b, c = sorted((r.randrange(len(a)), r.randrange(len(a))))
        rows.append((r.randrange(100), prose(r, r.randrange(25), words) + a[b:c] + r.choice(["", "é", "日本"]) + prose(r, r.randrange(9), words)))
    monkeypatch.setattr(repeats, "MANY", many)
    frame = spark.createDataFrame([(i, t, 1, "x", 2, 3) for i, t in rows], SCHEMA).repartition(3)
    source = repeats._source(frame, "doc_id", "text", [])
    if chunk != 1 << 21:  # the workers import the module themselves, so small chunks are tried in this process
        local(monkeypatch, rows, chunk, many)
    else:
        got = sorted(map(tuple, repeats.digests(frame).collect()), key=repr)
        assert got == brute_force(rows) and sum(row[2] for row in got) > 500
    assert source.count() == len(rows)


def local(monkeypatch, rows, chunk, many):
    """The tasks of the operator one after the other, with small chunks and batches of three rows."""
    monkeypatch.setattr(repeats, "_CHUNK", chunk)
    monkeypatch.setattr(repeats, "_PIECES", 200)
    texts = [(repeats._LAST_ID if i is None else i, k, (t or "").encode()) for k, (i, t) in enumerate(rows)]

    def table(made):
        return pa.concat_tables(pa.Table.from_batches([b]) for b in made)

    def small(t):
        return iter(t.combine_chunks().to_batches(max_chunksize=3))

    source = pa.table({"o": pa.array([x[0] for x in texts]), "v": pa.array([x[1] for x in texts], pa.int32()), "t": pa.array([x[2] for x in texts])})
    found = table(repeats._classes(small(table(repeats._index(iter(source.to_batches()))).sort_by([(k, "ascending") for k in ("s", "e", "doc_id")]))))
    asked, spans, classes = {}, {}, {}
    for x in found.to_pylist():
        if x["kind"] == repeats._ASK:
            classes[x["s"]] = classes.get(x["s"], 0) + 1
    for x in found.to_pylist():
        if x["kind"] == repeats._ASK:
            asked.setdefault(x["version"], []).append(x | {"many": classes[x["s"]] >= many})
        else:
            spans.setdefault(x["version"], []).append((x["start"], x["n"]))
    kind = pa.list_(pa.struct([("s", pa.int64()), ("start", pa.int64()), ("n", pa.int32()), ("many", pa.bool_())]))
    asking = pa.table({"o": [texts[v][0] for v in asked], "v": pa.array(list(asked), pa.int32()), "t": [texts[v][2] for v in asked], "a": pa.array([[{k: x[k] for k in ("s", "start", "n", "many")} for x in a] for a in asked.values()], kind)})
    pieces = table(repeats._pieces(iter(asking.to_batches())))
    for x in pieces.to_pylist():
        if x["kind"] == repeats._COPY:
            spans.setdefault(x["version"], []).append((x["start"], x["n"]))
    compared = pieces.filter(pa.compute.equal(pieces["kind"], repeats._ASK)).sort_by("key")
    for batch in repeats._copies(small(compared), groups=False):
        for x in batch.to_pylist():
            spans.setdefault(x["version"], []).append((x["start"], x["n"]))
    got = []
    for k, ((_, _, text), (own, _)) in enumerate(zip(texts, rows)):
        gone = np.zeros(len(text) + 1, bool)
        for start, n in spans.get(k, []):
            gone[start : start + n + 49] = True
        got.append((own, len(text), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum() + gone[0]), hashlib.sha256(bytes(b for b, g in zip(text, gone) if not g)).hexdigest()))
    assert sorted(got, key=repr) == brute_force(rows)


def test_nulls_short_long_and_repeated_rows(spark):
    long = " ".join(f"w{k}" for k in range(30_000))
    passage = "a passage of more than fifty bytes that some of them share, é"
    rows = [(1, passage + " one"), (2, "two " + passage), (2, "two " + passage), (3, None), (4, ""), (5, passage[:49]), (6, passage[:50] + "!")]
    rows += [(None, passage), (None, passage), (7, long), (8, long), (9, "ab" * 400), (9, "ab" * 300), (10, "x" + "ab" * 200), (0, "ba" * 30), (11, "日本" * 40)]
    found = {}
    for row in check(spark, rows):
        found.setdefault(row[0], []).append(row[2])
    assert found[8] == [len(long)] and found[7] == [0] and found[5] == [0] and found[None] == [63 - 1, 63 - 1] and found[10] == [400]
    assert repeats.digests(spark.createDataFrame([], SCHEMA)).collect() == []


def test_a_line_that_many_documents_share(spark, monkeypatch):
    """The blocks at its edges are all different; their seed is dealt by whole windows."""
    monkeypatch.setattr(repeats, "MANY", 20)
    r = random.Random(3)
    line = "this very common line is in a third of the documents of the table"
    rows = [(k, f"{r.random()}{r.random()} {line} {r.random()}{r.random()}" if k % 3 else f"{r.random()}" * 9) for k in range(150)]
    check(spark, rows)


def test_equals_sql_of_the_larger_table(spark, small):
    folder = small.replace("sf0.001", "sf0.01")
    assert_same(registry.op11_suffix_dedup(spark, folder), repeats.ORACLE, folder)


def test_intervals_equal_brute_force():
    """All groups of equal strings that can be extended to neither side, with all their occurrences."""
    r = random.Random(11)
    base = "".join(r.choice("abcd") for _ in range(400))
    pieces, docs = [], []
    for k in range(60):
        at = r.randrange(300)
        text = list(base[at : at + 84])
        text[r.randrange(84)] = r.choice("xyz")
        pieces.append("".join(text).encode())
        docs.append(r.randrange(12))
    n = np.array([len(p) - 49 for p in pieces])
    array = repeats.SuffixArray(pieces, n, np.array(docs))
    got = {}
    for length, first, last, differ, least, members in array.intervals():
        occurrences = frozenset((int(array.owner[m]), int(array.offset[m])) for m in range(first, last + 1))
        text = pieces[array.owner[first]][array.offset[first] : array.offset[first] + length]
        assert least == min(docs[o] for o, _ in occurrences)
        if differ:
            got[text] = occurrences
    want = {}
    for p, text in enumerate(pieces):
        for at in range(len(text) - 49):
            for q, other in enumerate(pieces):
                for to in range(len(other) - 49):
                    if (p, at) < (q, to) and docs[p] != docs[q] and text[at : at + 50] == other[to : to + 50]:
                        same = next((k for k in range(50, 85) if text[at : at + k + 1] != other[to : to + k + 1] or at + k >= len(text) or to + k >= len(other)), 84)
                        if at and to and text[at - 1] == other[to - 1]:
                            continue
                        want[text[at : at + same]] = None
    for text in want:
        want[text] = frozenset((p, at) for p, t in enumerate(pieces) for at in range(len(t) - len(text) + 1) if t[at : at + len(text)] == text)
    assert want and all(got.get(text) == occurrences for text, occurrences in want.items())


def test_maximal_repeats_lists_all_occurrences(spark):
    line = "0123456789" * 2 + "abcdefghijklmnopqrstuvwxyz" + "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    rows = [(k, f"<{k}>{line}({k})") for k in range(5)]
    frame = spark.createDataFrame([(i, t, 1, "x", 2, 3) for i, t in rows], SCHEMA)
    found = repeats.maximal_repeats(frame).collect()
    groups = {}
    for row in found:
        groups.setdefault(row["repeat"], []).append(row)
    assert groups and any(sorted(r.doc_id for r in g) == [0, 1, 2, 3, 4] for g in groups.values())
    texts = dict(rows)
    for g in groups.values():
        assert len({texts[r.doc_id].encode()[r.start : r.start + r.length] for r in g}) == 1


def test_blocks_are_shuffled_narrow_and_read_back_whole():
    """Five numbers a block are sorted, where it was seven; what they hold comes back bit by bit."""
    top, n = 0x7FFFFFFF, np.array([1, 49, repeats._SPAN, 7])
    s, e = np.array([0, 1, 2**64 - 1, 2**63], np.uint64), np.array([5, 2**64 - 1, 0, 9], np.uint64)
    plain = repeats._batch([0, 1, 1, 0], s, e, np.array([-3, 0, 7, repeats._LAST_ID]), np.array([top, 0, 1, top]), np.array([0, 2**31, 5, 6]), n)
    narrow = repeats._narrow(plain)
    assert narrow.schema.names == [column.split()[0] for column in repeats._DEALT.split(", ")]
    assert [c.tolist() for c in repeats._wide(narrow)] == [c.to_pylist() for c in plain.columns]
    indexed = list(repeats._index(iter([pa.record_batch({"o": [1], "v": pa.array([2], pa.int32()), "t": [bytes(range(60, 160))]})])))
    assert indexed and all(b.num_columns == 5 for b in indexed)


def test_arrays_of_a_chunk_stay_small():
    """A chunk is held as some ten arrays of a 64-bit number a byte: 235 and 269 MB in two workers with four times the bytes."""
    assert repeats._CHUNK <= 1 << 19 and repeats._PIECES <= 1 << 20


def test_tasks_get_small_batches(spark):
    """Whole texts are read and handed to Python in small batches, also where a result is made after its query has returned."""
    registry.ship(spark)
    assert spark.conf.get("spark.sql.parquet.columnarReaderBatchSize") == "1024"
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "8m"


def asked(texts):
    """Documents whose blocks are to be compared, by the tasks of the operator one after the other."""
    source = pa.record_batch({"o": list(range(len(texts))), "v": pa.array([0] * len(texts), pa.int32()), "t": texts})
    indexed = pa.concat_tables(pa.Table.from_batches([b]) for b in repeats._index(iter([source])))
    dealt = indexed.sort_by([(k, "ascending") for k in ("s", "e", "doc_id")]).combine_chunks()
    found = [b for b in repeats._classes(iter(dealt.to_batches(max_chunksize=7)))]
    return {x["doc_id"] for b in found for x in b.to_pylist() if x["kind"] == repeats._ASK}


def test_blocks_that_share_less_than_a_window_are_not_compared():
    """In a large corpus most seeds meet by chance; their texts are not gathered. What shares a window still is."""
    r = random.Random(5)

    def noise(n):
        return bytes(r.choice(b"abcdefghijklmnopqrstuvwxyz") for _ in range(n))

    met = []
    for _ in range(60):
        common = noise(32)  # a byte less than a seed and a side
        met += asked([noise(60) + common + noise(60), noise(70) + common + noise(70)])
    assert len(met) <= 4  # eight bits may agree by chance
    for left in range(0, 50, 7):
        common = noise(50)
        assert asked([noise(80) + common + noise(80), noise(left + 70) + common + noise(70)]) == {0, 1}
        assert asked([common + noise(left + 1), noise(left + 1) + common]) == {0, 1}
    period = noise(7)
    assert asked([noise(61) + period * 8 + noise(90), noise(64) + period[3:] + period * 7 + noise(90)]) == {0, 1}


def test_texts_of_unique_ids_are_not_told_apart(spark):
    """Their hash would be four bytes of every block in the shuffle."""
    one = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "doc_id long, text string")
    versions = [{x.version for x in repeats._source(frame, "doc_id", "text", []).collect()} for frame in (one, one.union(one.limit(1)), one.filter("doc_id IS NULL"))]
    assert versions[0] == versions[2] == {0} and len(versions[1]) == 3


def test_compared_pieces_are_gone_before_texts_are_shuffled(spark, monkeypatch):
    labels, write = [], repeats.save
    monkeypatch.setattr(repeats, "save", lambda frame, label: labels.append(label) or write(frame, label))
    check(spark, [(k, f"{k} " + "a passage of more than fifty bytes that all of them share" * 2 + f" {k}") for k in range(4)])
    assert labels == ["repeat-blocks", "repeat-pieces", "repeat-spans"]
