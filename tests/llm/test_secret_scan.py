import hashlib
import re

from pyspark.sql import functions as F

from tests.llm.helpers import EDGES, documents
from tradepath.llm import secret_scan

KINDS = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                          r"""([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII), 2, 12),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 16),
}


def base(text):
    spans = [(m.start(), i, m.end(), kind)
             for i, (kind, (pattern, group, least)) in enumerate(KINDS.items())
             for m in pattern.finditer(text or "") if len(m.group(group)) >= least]
    return [(kind, a, b) for a, _, b, kind in sorted(spans)]


def listed(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


HEX = "0123456789abcdef"
ROWS = [
    (1, "password=" + "x1" * 8 + " and passwd: 'short' secret = \"" + "Ab9." * 5 + '" end', "en", "s0"),
    (2, "ñ😀 Api_Key:" + "q" * 12 + " apikey=" + "q" * 11 + " TOKEN  =  zzzzzzzzzzzzzz", "en", "s1"),
    (3, "AKIA" + "B" * 14 + "x AKIA" + "B" * 13 + " AKIAAKIA" + "C" * 20, "en", "s2"),
    (4, f"{HEX} {HEX}{HEX} {HEX[:15]} token={HEX}", "en", "s3"),
    (5, "secret=api.token: longvalue12345 password=token=abcdefghijkl", "en", "s0"),
    (6, "ghp_abcDEF1234567890abcDEFghi only here", "en", "s0"),
    *((20 + i, "demo key sk_live_EXAMPLE00000000000000 again", "en", f"s{i}") for i in range(5)),
    (40, "password=" + "p" * 20, "en", None), (41, f"{HEX}\n" * 300, "en", "s0"),
]


def test_base_spans(spark):
    rows = secret_scan.digest(secret_scan.find_secrets(documents(spark, ROWS + EDGES))).collect()
    got = sorted(((r["doc_id"], r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"])
                  for r in rows), key=str)
    want = []
    for key, text, *_ in ROWS + EDGES:
        spans = base(text)
        count = [sum(k == kind for k, _, _ in spans) for kind in KINDS]
        want.append((key, *count, hashlib.sha256(listed(spans).encode()).hexdigest()))
    assert got == sorted(want, key=str)


def test_ownership(spark):
    rows = {r["doc_id"]: r for r in secret_scan.digest(
        secret_scan.find_secrets(documents(spark, ROWS))).collect()}
    assert rows[6]["spans"] == "live:0:29" and rows[6]["n_added"] == 1
    assert rows[20]["spans"] == ""  # five owners have it: an example
    for key, text, *_ in ROWS:
        spans = [s for s in rows[key]["spans"].split(",") if s and not s.startswith("live")]
        assert ",".join(spans) == listed(base(text))


def test_widely_copied_base_spans_stay(spark):
    docs = documents(spark, [(i, "token=EXAMPLEKEY123456", "en", f"s{i}") for i in range(4)])
    rows = secret_scan.digest(secret_scan.find_secrets(docs)).collect()
    assert {r["n_assign"] for r in rows} == {1} and {r["n_widely_copied"] for r in rows} == {1}
    assert {r["text"] for r in secret_scan.redact(docs).collect()} == {"token=EXAMPLEKEY123456"}


def test_redact(spark):
    docs = documents(spark, ROWS + EDGES)
    out = secret_scan.redact(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    text = {r["doc_id"]: r["text"] for r in secret_scan.redact(documents(spark, ROWS)).collect()}
    assert text[1] == "[secret] and passwd: 'short' [secret]\" end"
    assert text[2] == "ñ😀 [secret] apikey=qqqqqqqqqqq [secret]"
    assert text[6] == "[secret] only here" and "EXAMPLE" in text[20]
    assert out.where("doc_id = 1 AND text IS NULL").count() == 1


def test_empty_table(spark):
    assert secret_scan.digest(secret_scan.find_secrets(documents(spark, []))).collect() == []
    assert secret_scan.redact(documents(spark, [])).collect() == []


def test_no_python_on_the_main_path(spark):
    docs = documents(spark, ROWS)
    for frame in (secret_scan.digest(secret_scan.find_secrets(docs)), secret_scan.redact(docs)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_redact_with_clashing_names_and_without_owners(spark):
    rows = [(1, "password=abcdef123456789 and so on"), (2, "nothing"), (3, None),
            (1, "password=abcdef123456789 and so on")]
    docs = documents(spark, rows)
    for name in ("_spans", "_d", "_g", "_doc", "_h", "live", "spans"):
        docs = docs.withColumn(name, F.lit("own"))
    masked = secret_scan.redact(docs)
    assert masked.columns == docs.columns
    text = [(r["doc_id"], r["text"], r["_spans"], r["_d"]) for r in masked.collect()]
    assert sorted(text, key=str) == sorted(
        [(1, "[secret] and so on", "own", "own")] * 2 + [(2, "nothing", "own", "own"), (3, None, "own", "own")],
        key=str)
    bare = secret_scan.redact(docs.select("doc_id", "text"))
    assert {r["text"] for r in bare.collect()} == {"[secret] and so on", "nothing", None}


def test_spans_added_by_owners(spark):
    """A generic value of one owner is added; one that three owners in three documents have is not,
    and a base span of such a value is marked as widely copied."""
    own, shared, base = "Zx9kQ2mW7pLr4Tn8Vb3c", "Ab1Cd2Ef3Gh4Ij5Kl6Mn", "password=common1234567890"
    rows = [(i, f"see {own if i < 4 else shared} here {base}", "en", f"s{i // 2 if i < 4 else i}")
            for i in range(8)]
    found = {r["doc_id"]: r["spans"] for r in secret_scan.find_secrets(documents(spark, rows)).collect()}
    kinds = {i: sorted((s["kind"], s["live"]) for s in spans) for i, spans in found.items()}
    assert all(kinds[i] == [("assign", False), ("live", True)] for i in range(4))
    assert all(kinds[i] == [("assign", False)] for i in range(4, 8))
