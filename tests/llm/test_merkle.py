"""The Merkle manifest against a plain version that keeps no states."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from opslake.llm import op11_merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, lower=False):
    text = row[1]
    if lower and text is not None:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    values = (row[0], row[3], row[2], row[4], text)
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def raised(nodes):
    """All levels, from the nodes to the single one."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][at : at + 8]) for at in range(0, len(levels[-1]), 8)])
    return levels


def fold(levels, at, digest):
    proof = []
    for below in levels[:-1]:
        run = range(at - at % 8, min(at - at % 8 + 8, len(below)))
        proof += [below[k] for k in run if k != at]
        digest, at = h(*[digest if k == at else below[k] for k in run]), at // 8
    return digest, proof


def plain(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in groups:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {g: raised([leaf(r) for r in groups[g]]) for g in groups}
    top = raised([trees[g][-1][0] for g in order])
    out = []
    for g in order:
        for at, r in enumerate(groups[g]):
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            folded, low = fold(trees[g], at, leaf(r, tampered))
            folded, high = fold(top, order.index(g), folded)
            out.append((r[0], leaf(r), trees[g][-1][0], top[-1][0], h(*low, *high), folded, folded == top[-1][0]))
    return sorted(out, key=repr)


def found(df):
    crc = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    out = op11_merkle.manifest(df, tampered={"text": F.when(crc, op11_merkle.lower_ascii(F.col("text"))).otherwise(F.col("text"))})
    siblings = F.array_join(F.zip_with("left", "right", lambda a, b: F.concat(a, b)), "")
    rows = out.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256), "folded_root", "verified").collect()
    # Proofs stand by themselves: folding a leaf with left and right gives the root.
    alone = out.select(F.aggregate(F.zip_with("left", "right", lambda a, b: F.struct(a.alias("a"), b.alias("b"))), F.col("leaf"), lambda d, p: F.sha2(F.concat(p["a"], d, p["b"]), 256)).alias("d"), "root")
    assert alone.where("d <> root").count() == 0
    return sorted(map(tuple, rows), key=repr)


@pytest.fixture(scope="module")
def rows(rng):
    out = [(i, f"Text {i} " + "ÀBC x" * rng.randint(0, 5), "en", f"s{i % 3}", i) for i in rng.sample(range(10_000), 1100)]
    out += [(i, "Lone", f"l{i}", None, None) for i in range(9)]
    out += [(7, None, None, None, None), (None, "A", None, "s", 1), (None, None, "en", None, None), (3, "", "fr", "", 0), (3, "", "fr", "", 0), (3, "B", "fr", "", 0)]
    return [*out, (99_999, "Z" * 300_000, "fr", "s", 5)]


def test_equals_the_plain_version(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(df) == plain(rows)


def test_one_group_one_row_and_no_rows(spark, rows):
    some = [r for r in rows if r[2] == "fr"]
    assert found(spark.createDataFrame(some, SCHEMA)) == plain(some)
    one = rows[:1]
    got = found(spark.createDataFrame(one, SCHEMA))
    assert got == plain(one)
    assert got[0][1] == got[0][2] == got[0][3]
    assert found(spark.createDataFrame([], SCHEMA)) == []


def test_equal_rows_and_clashing_columns(spark):
    same = [(None, "Same", "en", "s", 4)] * 600 + [(6, "Same", None, "s", 4)] * 3
    df = spark.createDataFrame(same, SCHEMA).withColumns({c: F.lit(1) for c in ("k", "g", "pos", "n", "digest", "left", "right", "root", "_salt", "block", "name")})
    assert found(df) == plain(same)


def test_states_of_a_parent():
    tree = op11_merkle.Subtree([h(str(k)) for k in range(11)], 11)
    assert tree.states[0][3].hexdigest() == h(*[h(str(k)) for k in range(3)])
    assert tree.fold(9, h("9")) == tree.levels[-1][0] != tree.fold(9, h("x"))
