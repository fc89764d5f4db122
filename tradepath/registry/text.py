"""Review texts and JSON."""

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tradepath.functions import labels
from tradepath.functions import reference_data as ref
from tradepath.operators import terms
from tradepath.registry import register
from tradepath.registry.silver import r

_STOP = ", ".join(f"'{w}'" for w in ref.STOP_WORDS)
_WORD = terms.WORD.replace("'", "''")


def _words(source, keep=""):
    return f"""SELECT * FROM (SELECT {keep} regexp_replace(w, '''s$', '') AS word FROM (
        SELECT {keep} unnest(regexp_extract_all(lower(review_comment_message), '{_WORD}')) AS w
        FROM {source}))
      WHERE NOT regexp_full_match(word, '[0-9]+') AND word NOT IN ({_STOP})"""


@register("t01_top_words", f"""
    SELECT word, count(*) AS n FROM ({_words('m_reviews_text')})
    GROUP BY 1 ORDER BY n DESC, word LIMIT 100""")
def _(m):
    return terms.top_words(m.comments(), "review_comment_message", copies="copies")


_LOW = "m_reviews_text WHERE review_score = 1 AND review_comment_message IS NOT NULL"
_KEYS = ["tion", "ment", "privacy"]


def _has(k):
    return f"contains(lower(review_comment_message), '{k}')"


def _share_sql(keys):
    any_hit = " OR ".join(map(_has, keys))
    return f"""SELECT count(*) AS n_texts, count(*) FILTER (WHERE {any_hit}) AS n_any,
      {r(f'avg(CAST({any_hit} AS INT))')} AS share_any,
      {', '.join(r(f'avg(CAST({_has(k)} AS INT))') + f' AS share_{k}' for k in keys)} FROM {_LOW}"""


@register("t02_delivery_keyword_share", _share_sql(ref.DELIVERY_KEYWORDS))
def _(m):
    low = m.reviews_with_text.where("review_score = 1")
    return terms.keyword_share(low, "review_comment_message", ref.DELIVERY_KEYWORDS)


@register("t02_keyword_share", _share_sql(_KEYS))
def _(m):
    low = m.reviews_with_text.where("review_score = 1")
    return terms.keyword_share(low, "review_comment_message", _KEYS)


@register("t03_empty_text", """
    SELECT review_id, length(nullif(trim(CASE WHEN review_id % 7 = 0 THEN '   '
      ELSE review_comment_message END), '')) AS n_chars FROM m_reviews_text""")
def _(m):
    text = F.when(F.col("review_id") % 7 == 0, F.lit("   ")).otherwise(
        F.col("review_comment_message"))
    return m.reviews_with_text.select(
        "review_id", F.length(labels.clean_text(text)).cast("long").alias("n_chars"))


@register("t04_json_round_trip", """
    SELECT seller_id, seller_zip_code_prefix, seller_city, seller_state, CAST(to_json({
      'seller_id': seller_id, 'seller_zip_code_prefix': seller_zip_code_prefix,
      'seller_city': seller_city, 'seller_state': seller_state}) AS VARCHAR) AS body
    FROM m_sellers""")
def _(m):
    sellers = m.sellers.select("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state")
    body = F.to_json(F.struct(*sellers.columns), {"ignoreNullFields": "false"}).alias("body")
    schema = StructType.fromDDL("seller_id long, seller_zip_code_prefix string, "
                                "seller_city string, seller_state string")
    return sellers.select(body).select(F.from_json("body", schema).alias("s"), "body").select(
        "s.*", "body")


@register("t05_negative_vs_positive_terms", f"""
    WITH w AS ({_words('''(SELECT *, CASE WHEN review_score >= 4 THEN 'positive'
        WHEN review_score <= 2 THEN 'negative' ELSE 'neutral' END AS s FROM m_reviews_text
        WHERE review_score <> 3)''', 's,')}),
    c AS (SELECT word, count(*) FILTER (WHERE s = 'negative') AS n_first,
        count(*) FILTER (WHERE s = 'positive') AS n_second FROM w GROUP BY 1),
    t AS (SELECT sum(n_first) AS a, sum(n_second) AS b FROM c)
    SELECT word, n_first, n_second, {r('ln(((n_first + 1) / (a + 1)) / ((n_second + 1) / (b + 1)))')}
      AS log_ratio
    FROM c, t ORDER BY log_ratio DESC, word LIMIT 50""")
def _(m):
    rows = m.comments(labels.sentiment("review_score").alias("sentiment"))
    return terms.contrast(rows, "review_comment_message", "sentiment", "negative", "positive",
                          copies="copies")
