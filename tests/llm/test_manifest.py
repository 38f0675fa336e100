"""The manifest against one built by a plain loop."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from edges import edge_frame, empty_frame

from kerbside.llm import manifest

LOW = str.maketrans(manifest.UPPER, manifest.LOWER)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    values = (row.doc_id, row.source, row.lang, row.n_chars, text)
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(nodes, fan):
    found = [nodes]
    while len(found[-1]) > 1:
        found.append([digest("".join(found[-1][i:i + fan])) for i in range(0, len(found[-1]), fan)])
    return found


def expected(rows, fan):
    sources = defaultdict(list)
    for row in rows:
        sources[row.source].append((row.doc_id is not None, row.doc_id, leaf(row, row.text), row))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for source in order:
        sources[source].sort(key=lambda r: r[:3])
        trees.append(levels([r[2] for r in sources[source]], fan))
    top = levels([tree[-1][0] for tree in trees], fan)
    out = []
    for k, source in enumerate(order):
        for i, (known, doc_id, own, row) in enumerate(sources[source]):
            hit = known and zlib.crc32(str(doc_id).encode()) % 5 == 0 and row.text is not None
            at, proof = (leaf(row, row.text.translate(LOW)) if hit else own), ""
            for tree, place in ((trees[k], i), (top, k)):
                for nodes in tree[:-1]:
                    first = place // fan * fan
                    left, right = "".join(nodes[first:place]), "".join(nodes[place + 1:first + fan])
                    at, proof, place = digest(left + at + right), proof + left + right, place // fan
            out.append((doc_id, own, trees[k][-1][0], top[-1][0], digest(proof), at, at == top[-1][0]))
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, manifest.check_altered(df).collect()), key=str)


@pytest.mark.parametrize("fan", [2, 16])
def test_edge_rows(spark, monkeypatch, fan):
    monkeypatch.setattr(manifest, "FAN", fan)
    docs = edge_frame(spark)
    assert found(docs) == expected(docs.collect(), fan)


def test_trees_of_many_shapes(spark, monkeypatch):
    """Sources of 1 to 20 leaves and one of 150, equal rows among them, over ranges that cut sources apart."""
    monkeypatch.setattr(manifest, "FAN", 3)
    rows = [(i, f"Text {i}", None, f"s{n}", n) for n in range(1, 21) for i in range(n)]
    rows += [(i // 2, "Same", "en", None, 4) for i in range(150)] + [(7, "ÄA", "en", "é", 2), (7, "ÄA", "en", "z", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(7)
    assert found(docs) == expected(docs.collect(), 3)


def test_altered_documents_do_not_verify(spark, sf_dir):
    from kerbside.llm.queries import QUERIES
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op13_manifest"](spark, sf_dir).collect()
    assert len(rows) == len(texts) and len({r.root for r in rows}) == 1
    for row in rows:
        changed = texts[row.doc_id] and texts[row.doc_id].translate(LOW) != texts[row.doc_id]
        assert row.verified == (not changed or zlib.crc32(str(row.doc_id).encode()) % 5 != 0)


def test_empty_table(spark):
    rows = manifest.check_altered(empty_frame(spark))
    assert rows.collect() == [] and rows.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                                                     "verified"]


def test_a_level_is_dealt_once(spark):
    """The join with siblings and the aggregate after it read one shuffle."""
    from kerbside.session import setting
    rows = spark.createDataFrame([("t", i, str(i)) for i in range(100)], "tree string, index long, digest string")
    with setting(spark, manifest.BY_SOME_KEYS, "false"):
        df = manifest.steps(manifest.placed(rows))
        plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") - plan.count("ReusedExchange") <= 2 and "Exchange hashpartitioning(tree#" in plan
