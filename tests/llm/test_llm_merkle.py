import hashlib
import zlib

from oracle import assert_same

from tillbook.llm import merkle, registry

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, root int, tree int"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(values):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(nodes):
    made = [nodes]
    while len(made[-1]) > 1:
        made.append([h("".join(made[-1][k : k + 8])) for k in range(0, len(made[-1]), 8)])
    return made


def climb(made, at, node):
    proof = ""
    for level in made[:-1]:
        run = at // 8 * 8
        left, right = "".join(level[run:at]), "".join(level[at + 1 : run + 8])
        node, proof, at = h(left + node + right), proof + left + right, at // 8
    return node, proof


def lower(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute_force(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row, leaf(row[:5])))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for group in order:
        groups[group].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        trees[group] = levels([digest for _, digest in groups[group]])
    upper = levels([trees[g][-1][0] for g in order])
    out = []
    for k, group in enumerate(order):
        for at, (row, digest) in enumerate(groups[group]):
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
            start = leaf([*row[:4], lower(row[4])]) if tampered else digest
            node, proof = climb(trees[group], at, start)
            node, over = climb(upper, k, node)
            out.append((row[0], digest, trees[group][-1][0], upper[-1][0], h(proof + over), node, node == upper[-1][0]))
    return sorted(out, key=repr)


def check(spark, rows):
    frame = spark.createDataFrame([(*row, "x", 1, 2) for row in rows], SCHEMA)
    got = sorted(map(tuple, merkle.digests(frame).collect()), key=repr)
    assert got == brute_force(rows)


def test_equals_sql_at_a_larger_scale(spark, small):
    folder = small.replace("sf0.001", "sf0.01")
    assert_same(registry.op12_merkle(spark, folder), merkle.ORACLE, folder)


def test_blocks_of_blocks_groups_of_one_and_repeated_rows(spark):
    rows = [(k, "s", "en", k, f"Text {k}") for k in range(1100)]  # three blocks, the last short
    rows += [(k, None, "de", None, None) for k in range(513)]  # a block of a single leaf
    rows += [(5000, "s", "fr", 1, "Alone")] + [(7, "s", None, 1, "Null group")] * 9
    rows += [(6000 + k, "é", f"l{k}", 1, "ÄÖ Ünïcode É") for k in range(9)]  # more than eight groups
    rows += [(None, "s", "en", 1, "No id"), (None, "s", "en", 1, "No ID"), (3, "s", "en", 3, "Text 3")]
    check(spark, rows)


def test_one_group_of_one_and_empty(spark):
    check(spark, [(3, "s", "en", 1, "A" * 300_000)])
    check(spark, [(k, "s", "en", 1, "") for k in range(9)])
    assert merkle.digests(spark.createDataFrame([], SCHEMA)).collect() == []


def test_a_proof_of_each_row_leads_to_the_root(spark):
    rows = [(k, "s", "en" if k % 3 else "de", 1, f"T{k}") for k in range(700)]
    frame = spark.createDataFrame([(*row, "x", 1, 2) for row in rows], SCHEMA)
    made = merkle.manifest(frame).withColumn("folded", merkle.fold(merkle.F.col("leaf"), merkle.F.col("proof")))
    assert made.filter("folded <> root OR folded IS NULL").count() == 0 and made.count() == 700
