import re

from tests.llm.helpers import EDGES, ITEMS, documents, prose
from tradepath.llm import decontamination

WORD = re.compile(r"[^\W_]+")


def shingles(text, n=5):
    w = WORD.findall((text or "").lower())
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}


def plain(docs, items, threshold=0.8):
    a, b = {}, {}
    for out, rows in ((a, docs), (b, items)):
        for key, text, *_ in rows:
            out[key] = out.get(key, set()) | shingles(text)
    return sorted(((d, i, len(y), len(x & y)) for d, x in a.items() for i, y in b.items()
                   if y and len(x & y) >= threshold * len(y) - 1e-9), key=str)


def found(spark, docs, items):
    rows = decontamination.contained_items(
        documents(spark, docs), spark.createDataFrame([(*i[:2], 7) for i in items], ITEMS))
    return sorted((tuple(r)[:4] for r in rows.collect()), key=str)


def cases():
    items = [(i, prose(50 + i, 8 + 5 * i)) for i in range(12)]
    items += [(100, None), (101, ""), (102, "four words are few"), (103, "just five words in here"),
              (None, prose(77, 20)), (104, prose(50, 8)), (105, "ab " * 40), (106, prose(60, 30)),
              (106, prose(61, 30))]
    docs = [r[:2] for r in EDGES]
    for i, text in items[:12]:
        docs.append((200 + i, prose(300 + i, 500) + ". " + text.upper() + "! " + prose(400 + i, 20)))
        words = text.split()
        for k in range(4):  # one word changed after the other
            words[(k * 7) % len(words)] = f"w{k}"
            docs.append((500 + 10 * i + k, prose(600 + i, 200) + " " + " ".join(words)))
    docs.append((900, items[3][1] + " " + items[7][1]))
    docs.append((901, prose(77, 20)))
    return docs, items


def test_against_all_pairs(spark):
    docs, items = cases()
    want = plain(docs, items)
    assert len(want) > 15
    assert found(spark, docs, items) == want


def test_shuffled_join_gives_the_same(spark, monkeypatch):
    docs, items = cases()
    monkeypatch.setattr(decontamination, "small_side", lambda df: df)
    assert found(spark, docs, items) == plain(docs, items)


def test_empty_tables(spark):
    assert found(spark, [], [(1, prose(1, 30))]) == []
    assert found(spark, [(1, prose(1, 30))], []) == []


def test_no_python_on_the_main_path(spark):
    docs, items = cases()
    frame = decontamination.contained_items(
        documents(spark, docs), spark.createDataFrame([(*i[:2], 7) for i in items], ITEMS))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
