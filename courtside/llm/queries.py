"""Registered queries of the training-data operators, one per operator, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.llm import langid, toxicity
from courtside.llm.automaton_dedup import remove_repeated_words
from courtside.llm.collocations import collocations
from courtside.llm.common import crc_mod, table
from courtside.llm.ctph import fingerprint_neighbours
from courtside.llm.lsa_decontam import contaminated
from courtside.llm.ppm import score
from courtside.llm.sentencepiece_codec import codec_digests
from courtside.llm.simhash_dedup import simhash_components
from courtside.llm.suffix_dedup import remove_repeated_bytes
from courtside.llm.term_search import search
from courtside.llm.url_reputation import TWO_LABEL_SUFFIXES, judge_urls
from courtside.llm.warc_derivatives import derivatives, responses

URL_RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
             ("block", "net/es/"), ("block", "net/fr/"))


def op1_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url; a page is bad if its label says low quality or toxic."""
    labels = table(spark, sf_dir, "labels")
    outcomes = labels.select(F.col("doc_id").alias("page_id"),
                             ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int").alias("bad"))
    return judge_urls(table(spark, sf_dir, "pages"), outcomes, URL_RULES)


def op2_ctph_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and its edited text, and their likeness."""
    return fingerprint_neighbours(table(spark, sf_dir, "documents"))


def op3_lsa_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a document and a benchmark item that it holds."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("rk")


def piece_model(name: str = "piece_bpe_32k.model") -> bytes:
    """The bytes of an installed public SentencePiece model (0.5 MB), read on the driver."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


def op4_sentencepiece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids, decoded text and source spans of every whole text, as digests."""
    return codec_digests(table(spark, sf_dir, "documents"), piece_model())


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text; learnt from the rows whose crc32(doc_id) mod 4 is not 2."""
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod(F.col("doc_id"), 4) == 2
    out = langid.predict(docs.withColumn("held_out", held_out), langid.train(docs, ~held_out), carry=("held_out",))
    return out.select("doc_id", "held_out", "lang_pred", "score", "accepted")


def op6_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a response record, and the metadata and conversion records that refer to it."""
    return derivatives(responses(table(spark, sf_dir, "pages"), "2026-01-01T00:00:00Z"), carry=("page_id",))


def op7_automaton_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words in 50-word windows that start in a document with a smaller id are removed."""
    out = remove_repeated_words(table(spark, sf_dir, "documents"), 50)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 64-bit SimHash differs in at most 4 bits."""
    return simhash_components(table(spark, sf_dir, "documents"), 4, 4)


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes in 400-byte strings that also start elsewhere are removed."""
    out = remove_repeated_bytes(table(spark, sf_dir, "documents"), 400)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_ppm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PPM and unigram scores of all documents, learnt from those with crc32(doc_id) mod 7 other than 2."""
    return score(table(spark, sf_dir, "documents"), crc_mod(F.col("doc_id"), 7) != 2)


def op11_term_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of each benchmark item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 strongest phrases of two or three words of each language."""
    return collocations(table(spark, sf_dir, "documents"), min_count=10, top=2000, cover=50)


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text; learnt from the labelled rows whose crc32(doc_id) mod 4 is not 2."""
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod(F.col("doc_id"), 4) == 2
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held_out)
    return toxicity.score(docs.withColumn("held_out", held_out), model, carry=("held_out",))


REGISTRY = {
    "op1_url_reputation": op1_url_reputation,
    "op2_ctph_fingerprints": op2_ctph_fingerprints,
    "op3_lsa_decontamination": op3_lsa_decontamination,
    "op4_sentencepiece_codec": op4_sentencepiece_codec,
    "op5_language_id": op5_language_id,
    "op6_warc_derivatives": op6_warc_derivatives,
    "op7_automaton_dedup": op7_automaton_dedup,
    "op8_simhash_dedup": op8_simhash_dedup,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_ppm_scoring": op10_ppm_scoring,
    "op11_term_search": op11_term_search,
    "op12_collocations": op12_collocations,
    "op13_toxicity": op13_toxicity,
}

_RULE_SQL = "\n".join(
    f"WHEN (host = '{r.split('/')[0]}' OR ends_with(host, '.{r.split('/')[0]}')) "
    f"AND starts_with(path, '/{r.split('/', 1)[1]}') THEN '{r}'"
    for _, r in sorted(URL_RULES, key=lambda x: -len(x[1])))
_ACTION_SQL = " ".join(f"WHEN '{r}' THEN '{a}'" for a, r in URL_RULES)
_TWO = ", ".join(f"'{s}'" for s in TWO_LABEL_SUFFIXES)


def _strength_sql(children: str, parents: str, on: str) -> str:
    return f"""(SELECT 1 / greatest(0.005, least(0.5, coalesce(CASE WHEN df > 0 AND room > df
        THEN (s - df) / (room - df) ELSE 0 END, 0))) - 1
      FROM (SELECT sum(s) s, sum(k - 1) df, sum(pn - n2 / pn) room FROM (
        SELECT p.n::DOUBLE pn, sum(c.n * pow(c.b / c.n - (p.b + 0.5) / (p.n + 1.0), 2)
            / ((p.b + 0.5) / (p.n + 1.0) * (1 - (p.b + 0.5) / (p.n + 1.0)))) s, count(*) k, sum(c.n * c.n)::DOUBLE n2
        FROM {children} c JOIN {parents} p ON {on} WHERE c.n > 0 GROUP BY p.key, p.n)))"""


ORACLE = {"op1_url_reputation": f"""
WITH u AS (SELECT page_id,
    translate(coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
lab AS (SELECT doc_id, max((quality = 0 OR toxic = 1)::INT) AS bad FROM labels
  WHERE doc_id IS NOT NULL AND (quality = 0 OR toxic = 1) IS NOT NULL GROUP BY doc_id),
h0 AS (SELECT host, count(bad)::DOUBLE n, coalesce(sum(bad), 0)::DOUBLE b FROM u LEFT JOIN lab ON doc_id = page_id GROUP BY host),
h1 AS (SELECT *, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS name FROM h0),
h2 AS (SELECT *, regexp_extract(name, '([^.]*\\.)?[^.]*$') AS l2, regexp_extract(name, '([^.]*\\.)?([^.]*\\.)?[^.]*$') AS l3,
    regexp_extract(name, '[^.]*$') AS l1 FROM h1),
h AS (SELECT host AS key, host, n, b, CASE WHEN l2 IN ({_TWO}) THEN l3 ELSE l2 END AS domain,
    CASE WHEN l2 IN ({_TWO}) THEN l2 ELSE l1 END AS suffix FROM h2),
d AS (SELECT domain AS key, suffix, sum(n) n, sum(b) b FROM h GROUP BY domain, suffix),
s AS (SELECT suffix AS key, sum(n) n, sum(b) b FROM d GROUP BY suffix),
g AS (SELECT 'all' AS key, coalesce(sum(n), 0) n, coalesce(sum(b), 0) b FROM s),
c AS (SELECT (b + 0.5) / (n + 1.0) AS p0, {_strength_sql('s', 'g', 'true')} AS ms,
    {_strength_sql('d', 's', 'c.suffix = p.key')} AS md,
    {_strength_sql('h', 'd', 'c.domain = p.key AND c.suffix = p.suffix')} AS mh FROM g),
sp AS (SELECT s.key, (ms * p0 + b) / (ms + n) AS ps FROM s, c),
dp AS (SELECT d.key, d.suffix, (md * ps + b) / (md + n) AS pd FROM d JOIN sp ON sp.key = d.suffix, c),
hp AS (SELECT host, n, b, mh + n AS w, (mh * pd + b) / (mh + n) AS mean
  FROM h JOIN dp ON dp.key = h.domain AND dp.suffix = h.suffix, c),
r AS (SELECT host AS rh, n, b, round(mean, 6) AS bad_rate,
    round(pow(sin(greatest(0.0, asin(sqrt(mean)) - 1.645 / (2 * sqrt(w + 1)))), 2), 6) AS bad_lower FROM hp),
j AS (SELECT u.*, r.*, CASE {_RULE_SQL} END AS rule FROM u LEFT JOIN r ON r.rh = u.host)
SELECT page_id, host, path, rule,
  coalesce(CASE rule {_ACTION_SQL} END, CASE WHEN bad_lower > 0.5 THEN 'block' ELSE 'allow' END) AS verdict,
  n::BIGINT AS n_labelled, b::BIGINT AS n_bad, bad_rate, bad_lower FROM j""",
          "op7_automaton_dedup": """
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d),
k AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM s),
m AS (SELECT h, min(doc_id) AS lo FROM k GROUP BY h),
hit AS (SELECT doc_id, i FROM k JOIN m USING (h) WHERE lo < doc_id),
gone AS (SELECT DISTINCT doc_id, i + o AS p FROM (SELECT doc_id, i, unnest(range(0, 50)) AS o FROM hit)),
g AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id),
u AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS txt FROM u ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(g.n, 0)::BIGINT AS n_removed,
  sha256(coalesce(kept.txt, '')) AS kept_sha256
FROM d LEFT JOIN g USING (doc_id) LEFT JOIN kept USING (doc_id)"""}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

ORACLE["op11_term_search"] = f"""
WITH w AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all({_LOWER},
    '{_TERM}') AS t FROM documents),
d AS (SELECT * FROM w WHERE len(t) > 0),
c AS (SELECT count(*)::BIGINT AS nd, coalesce(sum(len(t)), 0)::BIGINT AS l FROM d),
q AS (SELECT item_id, t, count(*) AS times FROM (SELECT item_id, unnest(regexp_extract_all(
    {_LOWER},
    '{_TERM}')) AS t FROM benchmark) GROUP BY item_id, t),
p AS (SELECT r, doc_id, len(t)::BIGINT AS n, unnest(t) AS t FROM d),
tf AS (SELECT r, doc_id, n, t, count(*) AS tf FROM p SEMI JOIN q USING (t) GROUP BY r, doc_id, n, t),
wt AS (SELECT t, floor(1000 * ln((2 * any_value(nd) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, c GROUP BY t),
s AS (SELECT item_id, r, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * nd) // l))))::BIGINT AS score
  FROM tf JOIN wt USING (t) JOIN q USING (t), c GROUP BY item_id, r, doc_id),
k AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM s WHERE score > 0)
SELECT * FROM k WHERE rank <= 10"""

ORACLE["op12_collocations"] = rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS d, {_LOWER} AS t FROM documents),
q AS (SELECT lang, d, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS s FROM p),
q2 AS (SELECT lang, row_number() OVER () AS d, list_filter(regexp_split_to_array(s, '[\x20\x09]+'), lambda x: x <> '') AS w FROM q),
q3 AS (SELECT lang, d, unnest(w) AS w1, generate_subscripts(w, 1) AS i FROM q2),
tok AS (SELECT lang, w1, lead(w1) OVER o AS w2, lead(w1, 2) OVER o AS w3 FROM q3 WINDOW o AS (PARTITION BY d ORDER BY i)),
g1 AS (SELECT lang, w1, count(*)::HUGEINT AS f FROM tok GROUP BY ALL),
g2 AS (SELECT lang, w1, w2, count(*)::HUGEINT AS f FROM tok WHERE w2 IS NOT NULL GROUP BY ALL HAVING f >= 10),
g3 AS (SELECT lang, w1, w2, w3, count(*)::HUGEINT AS f FROM tok WHERE w3 IS NOT NULL GROUP BY ALL HAVING f >= 10),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM g1 GROUP BY lang),
begins AS (SELECT lang, w1, w2, max(f) AS m, count(*) AS c FROM g3 GROUP BY ALL),
ends AS (SELECT lang, w2 AS w1, w3 AS w2, max(f) AS m, count(*) AS c FROM g3 GROUP BY ALL),
two AS (SELECT lang, w1 || ' ' || w2 AS phrase, g2.f AS a, x.f AS l, y.f AS r, 1000000 * a * a // (x.f * y.f) AS score,
    coalesce(e.c, 0) AS left_words, coalesce(b.c, 0) AS right_words
  FROM g2 JOIN g1 AS x USING (lang, w1) JOIN (SELECT lang, w1 AS w2, f FROM g1) AS y USING (lang, w2)
    LEFT JOIN begins AS b USING (lang, w1, w2) LEFT JOIN ends AS e USING (lang, w1, w2)
  WHERE 100 * greatest(coalesce(b.m, 0), coalesce(e.m, 0)) < 50 * g2.f),
cuts AS (SELECT lang, w1 || ' ' || w2 || ' ' || w3 AS phrase, g3.f AS a, x.f AS l1, y.f AS r1, z.f AS l2, v.f AS r2,
    1000000 * a * a // (x.f * y.f) AS s1, 1000000 * a * a // (z.f * v.f) AS s2
  FROM g3 JOIN g1 AS x USING (lang, w1) JOIN (SELECT lang, w1 AS w2, w2 AS w3, f FROM g2) AS y USING (lang, w2, w3)
    JOIN g2 AS z USING (lang, w1, w2) JOIN (SELECT lang, w1 AS w3, f FROM g1) AS v USING (lang, w3)),
c AS (SELECT * FROM two UNION ALL SELECT lang, phrase, a, if(s1 <= s2, l1, l2), if(s1 <= s2, r1, r2), least(s1, s2), 0, 0 FROM cuts),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM c)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score, left_words, right_words
FROM o JOIN n USING (lang) WHERE rank <= 2000"""
