"""The registered queries of this package: ``QUERIES[name] = (run, duckdb_sql or None)``."""

from pyspark.sql import functions as F

from sievelog.llm import bpe_codec, chat_format, language_id, secret_scan, sentencepiece_codec, toxicity
from sievelog.llm.common import held_out, materialise, table
from sievelog.llm.exact_dedup import exact_duplicates
from sievelog.llm.fill_in_middle import fill_in_middle, restored_text
from sievelog.llm.filter_audit import filter_audit
from sievelog.llm.minhash_dedup import near_duplicates
from sievelog.llm.mixing import mix_sources
from sievelog.llm.passage_dedup import remove_repeats
from sievelog.llm.quality_rules import RULES, domain_of, quality_rules

# ---- language ---------------------------------------------------------------------


def op1_language_id(spark, sf):
    docs = table(spark, sf, "documents")
    model = language_id.fit(docs.where(~held_out(F.col("doc_id"))))
    told = language_id.identify(docs.select("doc_id", "text"), model)
    return told.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "accepted"
    )


# ---- toxicity ---------------------------------------------------------------------


def op4_toxicity(spark, sf):
    docs = table(spark, sf, "documents")
    labels = table(spark, sf, "labels").where(~held_out(F.col("doc_id")))
    weights, bias = toxicity.fit(toxicity.training_rows(docs, labels))
    scored = toxicity.score(docs, weights, bias)
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


# ---- mixing sources ---------------------------------------------------------------


def op2_mix_sources(spark, sf):
    return mix_sources(table(spark, sf, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')), 1, 15))::BIGINT AS shuffle
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS nth FROM s),
v AS (SELECT *, [5.0, 2.0, 1.0][nth % 3 + 1]::DOUBLE AS weight, source_size * 2.0::DOUBLE AS most FROM w),
f AS (SELECT *, most * (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0))
          <= (1.5 * sum(source_size) OVER () - coalesce(sum(most) OVER b, 0)) * weight AS is_full
      FROM v WINDOW b AS (ORDER BY most / weight, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT *, CASE WHEN is_full THEN most ELSE weight * (1.5 * sum(source_size) OVER () - sum(CASE WHEN is_full THEN most ELSE 0 END) OVER ())
          / nullif(sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER (), 0) END::DOUBLE AS target FROM f),
q AS (SELECT doc_id, d.source, shuffle, size, source_size, target,
             sum(size) OVER (PARTITION BY d.source ORDER BY shuffle, doc_id RANGE UNBOUNDED PRECEDING) AS done
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT doc_id, shuffle, size, (done + k * source_size) / nullif(target, 0) AS finish, k
      FROM q, (SELECT unnest([0, 1]) AS k) WHERE size > 0),
m AS (SELECT *, sum(size) OVER (ORDER BY finish, shuffle, doc_id, k RANGE UNBOUNDED PRECEDING) AS upto FROM c),
n AS (SELECT doc_id, shuffle, count(*) AS copies FROM m WHERE upto <= 1.5 * (SELECT sum(size) FROM d) GROUP BY ALL)
SELECT q.doc_id, size, source_size, coalesce(target, 0) AS target, (coalesce(copies, 0) * size)::BIGINT AS taken
FROM q LEFT JOIN n ON q.shuffle = n.shuffle AND q.doc_id IS NOT DISTINCT FROM n.doc_id"""

# ---- pieces -----------------------------------------------------------------------


def op3_sentencepiece(spark, sf):
    return sentencepiece_codec.encode_documents(table(spark, sf, "documents"), sentencepiece_codec.load_model(spark))


# ---- exact duplicates -------------------------------------------------------------


def op5_exact_dedup(spark, sf):
    return exact_duplicates(table(spark, sf, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


OP5_SQL = r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS s FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY s) AS keep_id, count(*) OVER (PARTITION BY s) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY s) AS kept, s AS text_sha256 FROM t"""

# ---- chat windows -----------------------------------------------------------------

CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


def op6_chat_format(spark, sf):
    extra = [F.struct(F.lit(-1).alias("conv_id"), F.lit(n).alias("turn"), F.lit(r).alias("role"), F.lit(CONTROL_TEXT).alias("text")) for n, r in enumerate(("user", "assistant"))]
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(spark.range(1).select(F.inline(F.array(*extra))))
    return chat_format.read_back(materialise(chat_format.chat_windows(rows), "chat-windows"))


# ---- repeated passages ------------------------------------------------------------


def op7_suffix_dedup(spark, sf):
    return remove_repeats(table(spark, sf, "documents"), keep_text=False).drop("kept")


# ---- near duplicates --------------------------------------------------------------


def op8_minhash_dedup(spark, sf):
    return near_duplicates(table(spark, sf, "documents")).select("doc_id", "class_id", "class_size", "n_links", "kept")


# ---- secrets ----------------------------------------------------------------------


def op9_secret_scan(spark, sf):
    found = secret_scan.secret_spans(table(spark, sf, "documents"))
    base = [n for n, r in enumerate(secret_scan.RULES) if r.kind in secret_scan.BASE]
    rules = F.transform("spans", lambda s: s["rule"])
    counts = [
        (F.size(rules) - F.size(F.array_remove(rules, n))).cast("long").alias(f"n_{secret_scan.RULES[n].kind}") for n in base
    ]
    listed = secret_scan.spans_text(F.filter("spans", lambda s: s["rule"].isin(base)))
    return found.select(
        "doc_id", *counts, F.sha2(listed.cast("binary"), 256).alias("base_sha256"), secret_scan.spans_text(F.col("spans")).alias("spans")
    )


def _sql_any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


#: Spelt in both cases in SQL: DuckDB also folds letters beyond ASCII.
KEYWORDS = ("password", "passwd", "secret", "token", "api_?key")


def _sql_pattern(rule) -> str:
    pattern = rule.pattern
    for word in KEYWORDS:
        pattern = pattern.replace(word, _sql_any_case(word))
    return pattern.replace("(?i:", "(?:").replace("'", "''")


def _op9_sql() -> str:
    parts = []
    for n, r in enumerate(secret_scan.RULES):
        p = _sql_pattern(r)
        parts.append(f"""
SELECT doc_id, {n} AS rule, '{r.kind}' AS kind, g, e - length(m) AS b, e FROM (
  SELECT doc_id, m, g, sum(length(m) + length(gap)) OVER (PARTITION BY doc_id ORDER BY i) AS e FROM (
    SELECT doc_id, unnest(regexp_extract_all(t, '{p}')) AS m, unnest(regexp_extract_all(t, '{p}', {r.group})) AS g,
           unnest(regexp_split_to_array(t, '{p}')[:-2]) AS gap, unnest(range(len(regexp_extract_all(t, '{p}')))) AS i FROM d))
WHERE length(g) >= {r.least}""")
    listed = "string_agg(kind || ':' || b || ':' || e, ',' ORDER BY b, rule)"
    counts = ", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in secret_scan.BASE)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
s AS ({" UNION ALL ".join(parts)}),
a AS (SELECT doc_id, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in secret_scan.BASE)},
             {listed} FILTER (rule < 3) AS base, {listed} AS spans FROM s GROUP BY doc_id)
SELECT doc_id, {counts}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN a USING (doc_id)"""


# ---- quality rules ----------------------------------------------------------------


def op10_quality_rules(spark, sf):
    return quality_rules(table(spark, sf, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


OP10_SQL = r"""
WITH d AS (SELECT doc_id, source, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
                  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
           FROM (SELECT doc_id, source, coalesce(text, '') AS t FROM documents)),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n
      FROM (SELECT doc_id, unnest(range(len(w) - 2)) AS i, unnest(w[:-3]) AS a, unnest(w[2:-2]) AS b, unnest(w[3:]) AS c FROM d WHERE len(w) > 2)),
r AS (SELECT doc_id, sum(least(3, coalesce(nxt - i, 3)))::BIGINT AS n_repeat_words
      FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM g WHERE n > 1) GROUP BY doc_id),
m AS (SELECT doc_id, source, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
             (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
      FROM d LEFT JOIN r USING (doc_id)),
f AS (SELECT *, n_words < 50 AS f1, 100 * n_repeat_words > 50 * n_words AS f2, 5 * n_symbols > word_chars AS f3, 2 * n_dup_lines > n_lines AS f4 FROM m),
h AS (SELECT source, count(*) AS n, unnest([sum(f1::INT), sum(f2::INT), sum(f3::INT), sum(f4::INT)]) AS k, unnest([1, 2, 3, 4]) AS rule FROM f GROUP BY source),
p AS (SELECT rule, avg(k / n) AS mean, greatest(1, least(1000, CASE WHEN var_pop(k / n) > 0 THEN avg(k / n) * (1 - avg(k / n)) / var_pop(k / n) - 1 ELSE 1000 END)) AS prior
      FROM h GROUP BY rule),
o AS (SELECT source, bool_or((k + mean * prior) / (n + prior) > 0.5) AS failed FROM h JOIN p USING (rule) GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, f1 OR f2 AS base_failed, NOT (f1 OR f2 OR failed) AS kept
FROM f JOIN o ON f.source IS NOT DISTINCT FROM o.source"""


#: Rules for raw pages: markup counts as symbols, and a domain goes at 30 %.
PAGE_RULES = {"short": RULES["short"], "repeated": RULES["repeated"], "markup": "10 * n_symbols > word_chars"}


def quality_rules_by_domain(spark, sf):
    """Verdicts on the domains of raw pages, joined back to their pages; some domains fail."""
    pages = table(spark, sf, "pages")
    out = quality_rules(pages, "page_id", "html", domain_of(F.col("url"), 3), PAGE_RULES, 0.3)
    return out.select(F.col("doc_id").alias("page_id"), F.col("host").alias("domain"), "n_symbols", "base_failed", "host_failed", "kept")


def _page_sql() -> str:
    host = r"lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)', 1))"
    source = f"array_to_string(string_split({host}, '.')[-3:], '.')"
    sql = OP10_SQL[: OP10_SQL.rindex("SELECT doc_id")]
    sql = sql.replace("coalesce(text, '') AS t FROM documents", f"coalesce(html, '') AS t FROM (SELECT page_id AS doc_id, html, {source} AS source FROM pages)")
    sql = sql.replace("5 * n_symbols > word_chars AS f3", "10 * n_symbols > word_chars AS f3").replace("2 * n_dup_lines > n_lines AS f4", "false AS f4")
    sql = sql.replace("> 0.5) AS failed", "> 0.3) AS failed")
    return sql + """SELECT doc_id AS page_id, f.source AS domain, n_symbols, f1 OR f2 AS base_failed, failed AS host_failed,
       NOT (f1 OR f2 OR failed) AS kept FROM f JOIN o ON f.source IS NOT DISTINCT FROM o.source"""

# ---- fill in the middle -----------------------------------------------------------


def op11_fill_in_middle(spark, sf):
    cut = fill_in_middle(table(spark, sf, "documents"))
    digest = lambda text: F.sha2(text.cast("binary"), 256)
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        digest(F.col("output")).alias("output_sha256"),
        digest(restored_text(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )


OP11_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS s FROM documents),
h AS (SELECT *, length(t) AS n, ('0x' || s[1:8])::BIGINT AS h1, ('0x' || s[9:16])::BIGINT AS h2,
             ('0x' || s[17:24])::BIGINT AS h3, ('0x' || s[25:32])::BIGINT AS h4 FROM d),
f AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
             CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                  WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, substring(t, 1, a) AS pre, substring(t, a + 1, b - a) AS mid, substring(t, b + 1) AS suf FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256 FROM p"""

# ---- byte-level BPE ---------------------------------------------------------------


def op12_bpe(spark, sf):
    vocabulary = bpe_codec.load_vocabulary(spark)
    coded = bpe_codec.encode_documents(table(spark, sf, "documents"), vocabulary)
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    coded = coded.withColumn("ids_sha256", F.sha2(listed.cast("binary"), 256))
    return bpe_codec.decode_documents(coded, vocabulary).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256")
    )


# ---- filter interaction -----------------------------------------------------------


def op13_filter_audit(spark, sf):
    return filter_audit(table(spark, sf, "documents"), table(spark, sf, "labels"))


OP13_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY t) AS least_id FROM d),
l AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
             (len(w) < 50)::INT + 2 * (100 * len(list_distinct(w)) < 65 * len(w))::INT
             + 4 * (100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 5 * length(t))::INT
             + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(least_id < doc_id, false)::INT AS bits
      FROM w LEFT JOIN l USING (doc_id)),
c AS (SELECT part, good, toxic, bits, count(*) AS n FROM f GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
o AS (SELECT a.l || b.l || c.l || d.l || e.l AS filter_order FROM x a, x b, x c, x d, x e
      WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
s AS (SELECT filter_order, step, 1 << (instr('ABCDE', filter_order[step]) - 1) AS here,
             list_sum(list_transform(range(1, step), lambda i: 1 << (instr('ABCDE', filter_order[i]) - 1))) AS before
      FROM o, (SELECT unnest(range(1, 6)) AS step)),
r AS (SELECT part, filter_order, step, here,
             sum(n) FILTER (bits & here = 0 AND bits & coalesce(before, 0)::INT = 0) AS kept,
             sum(n) FILTER (bits & here > 0 AND bits & coalesce(before, 0)::INT = 0) AS removed,
             sum(n) FILTER (bits & here > 0 AND bits & coalesce(before, 0)::INT > 0) AS redundant,
             sum(n) FILTER (bits = here) AS unique_fails,
             sum(n) FILTER (good AND bits & here > 0 AND bits & coalesce(before, 0)::INT = 0) AS good_lost,
             sum(n) FILTER (toxic AND bits & here > 0 AND bits & coalesce(before, 0)::INT = 0) AS toxic_lost
      FROM c, s GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       coalesce(sum(removed) OVER (PARTITION BY part, here), 0)::BIGINT AS shapley FROM r"""


QUERIES = {
    "op1_language_id": (op1_language_id, None),
    "op2_mix_sources": (op2_mix_sources, OP2_SQL),
    "op3_sentencepiece": (op3_sentencepiece, None),
    "op4_toxicity": (op4_toxicity, None),
    "op5_exact_dedup": (op5_exact_dedup, OP5_SQL),
    "op6_chat_format": (op6_chat_format, None),
    "op7_suffix_dedup": (op7_suffix_dedup, None),
    "op8_minhash_dedup": (op8_minhash_dedup, None),
    "op9_secret_scan": (op9_secret_scan, _op9_sql()),
    "op10_quality_rules": (op10_quality_rules, OP10_SQL),
    "quality_rules_by_domain": (quality_rules_by_domain, _page_sql()),
    "op11_fill_in_middle": (op11_fill_in_middle, OP11_SQL),
    "op12_bpe": (op12_bpe, None),
    "op13_filter_audit": (op13_filter_audit, OP13_SQL),
}
