"""The stages against plain versions, each on its own input."""

from collections import defaultdict

import pytest

import corpus_pipeline
from tests.llm.helpers import EDGES, ITEMS, documents, prose
from tests.llm.test_decontamination import plain as plain_items
from tests.llm.test_jaccard import plain as plain_groups
from tests.llm.test_models import labelled, toxic_corpus
from tests.llm.test_packing import check, ids, tokenizer  # noqa: F401
from tradepath.llm import secret_scan, toxicity


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    docs, labels = toxic_corpus(200)
    item = prose(5050, 40)
    docs += [(300, docs[1][1] + " more"), (301, docs[1][1]), (302, prose(51, 90) + " " + item),
             (303, "password=abcdef123456789 " + prose(52, 70))]
    docs += [(r[0] if r[0] is None else r[0] + 1000, *r[1:]) for r in EDGES]
    path = str(tmp_path_factory.mktemp("sf"))
    documents(spark, docs).write.parquet(f"{path}/documents.parquet")
    labelled(spark, labels).write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item, 5)], ITEMS).write.parquet(f"{path}/benchmark.parquet")
    return path


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def plain_rows(spark, rows):
    """The rows that stay: of each group the one with the least id (nulls last), then the least hash
    of its text; rows without a word stay, but of exact repeats with an id one does."""
    hashes = spark.createDataFrame(
        [(i, t) for i, (_, t) in enumerate(rows)], "i long, t string").selectExpr(
        "i", "xxhash64(t) AS h").collect()
    h = {r["i"]: r["h"] for r in hashes}
    order = [(k is None, k or 0, h[i]) for i, (k, _) in enumerate(rows)]
    out, seen = [], set()
    groups = plain_groups([((*order[i], i), t) for i, (_, t) in enumerate(rows)])
    for (no, k, x, i), least, links in sorted(groups):
        repeats = (no, k, x) in seen and (links or not no)
        if (no, k, x) == least[:3] and not repeats:
            out.append(rows[i])
        seen.add((no, k, x))
    return out


def test_stages(spark, folder, tokenizer):  # noqa: F811
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "ngram_jaccard_join", "benchmark_decontamination", "secret_scan",
                     "best_fit_packing"]
    stages = dict(corpus_pipeline.STAGES)
    labels = spark.read.parquet(f"{folder}/labels.parquet")

    clean = stages["toxicity"](spark, docs, folder)
    toxic = {r["doc_id"] for r in toxicity.score(docs, labels).where("predicted = 1").collect()}
    assert len(toxic) > 20
    # 1006 and the null id stand for several texts, each judged by itself
    alone = "doc_id IS NOT NULL AND doc_id != 1006"
    assert rows_of(clean.where(alone)) == rows_of(
        docs.where(alone).where(~docs["doc_id"].isin(*toxic)))

    one = stages["ngram_jaccard_join"](spark, clean, folder)
    before = [(r["doc_id"], r["text"]) for r in clean.collect()]
    assert rows_of(one.select("doc_id", "text")) == sorted(plain_rows(spark, before), key=str)
    assert one.where("doc_id IN (300, 301)").count() == 0

    apart = stages["benchmark_decontamination"](spark, one, folder)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    found = {k for k, *_ in plain_items([(r["doc_id"], r["text"]) for r in one.collect()], items)}
    assert found == {302}
    assert rows_of(apart) == rows_of(one.where("doc_id IS NULL OR doc_id != 302"))

    masked = stages["secret_scan"](spark, apart, folder)
    text = {r["doc_id"]: r["text"] for r in masked.collect()}
    assert text[303].startswith("[secret] ") and masked.count() == apart.count()
    live = {r["doc_id"] for r in secret_scan.find_secrets(apart).collect()
            if any(s["live"] for s in r["spans"])}
    assert rows_of(masked.where(~masked["doc_id"].isin(*live) | masked["doc_id"].isNull())) == rows_of(
        apart.where(~apart["doc_id"].isin(*live) | apart["doc_id"].isNull()))
    for stage in (clean, one, apart, masked):
        assert stage.columns == docs.columns

    want = defaultdict(list)
    for r in masked.collect():
        want[r["doc_id"]].append(ids(tokenizer, r["text"]))
    assert check(stages["best_fit_packing"](spark, masked, folder).collect(), want, 1024) > 0


def test_rows_are_judged_by_their_own_text(spark, tmp_path):
    """Ids that stand for several texts, and many rows without an id."""
    item, a, b, c = prose(5050, 40), prose(11, 200), prose(12, 90), prose(13, 150)
    docs = [(6, a), (6, a), (6, b), (8, a), (None, a), (None, c), (None, c + " more"), (None, None),
            (None, None), (9, prose(14, 60)), (9, c), (9, prose(15, 70) + " " + item),
            (None, prose(16, 80) + " " + item), (3, b + " end"), (7, "!"), (7, "!"), (7, "?")]
    spark.createDataFrame([(1, item, 5)], ITEMS).write.parquet(f"{tmp_path}/benchmark.parquet")
    stages = dict(corpus_pipeline.STAGES)
    frame = documents(spark, docs)
    one = stages["ngram_jaccard_join"](spark, frame, str(tmp_path))
    want = [(6, a), (None, None), (None, None), (9, prose(14, 60)), (9, c), docs[11], docs[12],
            (3, b + " end"), (7, "!"), (7, "?")]
    assert rows_of(one.select("doc_id", "text")) == sorted(want, key=str)
    apart = stages["benchmark_decontamination"](spark, one, str(tmp_path))
    assert rows_of(apart.select("doc_id", "text")) == sorted(
        (r for r in want if r not in (docs[11], docs[12])), key=str)
    assert one.columns == apart.columns == frame.columns


def test_run(spark, folder):
    out = corpus_pipeline.run(spark, folder)
    assert out.columns[0] == "doc_id" and out.where("doc_id IN (300, 301, 302)").count() == 0


def test_empty_tables(spark, tmp_path):
    documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    labelled(spark, []).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], ITEMS).write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
