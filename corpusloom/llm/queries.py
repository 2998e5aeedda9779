"""One query per operator, over the whole of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import (
    filter_audit,
    hilbert,
    html_text,
    importance,
    infill,
    language,
    leaks,
    line_dedup,
    near_dup,
    packing,
    pigeonring,
    quality_rules,
    url_filter,
)
from corpusloom.llm.registry import QUERIES, SQL, query, table  # noqa: F401

SETTLED = 200  # rounds: 0.85 ** 200 is below 1e-14
URL_RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))


@query()
def op1_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extracted(table(spark, folder, "pages"))


@query()
def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(table(spark, folder, "documents"))


@query("""
    WITH RECURSIVE cut AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\\x20\\x09-\\x0D]+') AS w FROM documents
    ), shingles AS MATERIALIZED (
        SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
               ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM cut
    ), sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
    ), common AS (
        SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM shingles a JOIN shingles b USING (s)
        WHERE a.doc_id <> b.doc_id GROUP BY ALL
    ), links AS MATERIALIZED (
        SELECT u, v FROM common JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v WHERE 100 * c >= 85 * (x.n + y.n - c)
    ), reached AS (
        SELECT u, v FROM links UNION SELECT r.u, l.v FROM reached r JOIN links l ON l.u = r.v
    ), least AS (SELECT u AS doc_id, min(v) AS m FROM reached GROUP BY u)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id,
           doc_id = least(doc_id, coalesce(m, doc_id)) AS kept
    FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id)
""")
def op3_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, folder, "documents"))


@query()
def op4_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return importance.resampled(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("""
    WITH lines AS (
        SELECT doc_id, pos, line, lower_ascii AS key FROM (
            SELECT doc_id, pos, lines[pos] AS line,
                   translate(regexp_replace(lines[pos], '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_ascii
            FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS pos
                  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents))
        )
    ), often AS (
        SELECT key, max(doc_id) AS last FROM lines WHERE length(key) >= 20
        GROUP BY key HAVING count(DISTINCT doc_id) >= 3
    ), marked AS (
        SELECT l.*, o.last IS NOT NULL AND doc_id < o.last AS dropped FROM lines l LEFT JOIN often o USING (key)
    )
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
    FROM marked GROUP BY doc_id
""")
def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = line_dedup.dedup_lines(table(spark, folder, "documents").select("doc_id", "text"))
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    return docs.select("doc_id", "n_lines", "n_dropped", digest.alias("kept_sha256"))


@query()
def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    judged = quality_rules.judged(docs, table(spark, folder, "labels"))
    return judged.select("doc_id", *quality_rules.COUNTS, "base_failed", "kept", "rule")


# Fixed value: 3988292384 is the reversed polynomial of CRC-32. The engine has no such function.
CRC_TABLE_SQL = """SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS crcs"""
CRC_SQL = """xor(4294967295, list_reduce(list_concat([4294967295],
    list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT)),
    lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])))"""


def _hilbert_sql() -> str:
    """The steps of the curve one by one, each a query around the one before it; then ranks over the whole table."""
    size = "least(63, 2 * length(bin(size)) + CASE WHEN substr(bin(size), 2, 1) = '1' THEN 1 ELSE 0 END)"
    cells = """{0}s AS MATERIALIZED (SELECT {0}, (row_number() OVER (ORDER BY {0}) - 1) * 63 // count(*) OVER () + 1 AS {0}_cell
        FROM (SELECT DISTINCT {0} FROM documents WHERE {0} IS NOT NULL))"""
    rows = f"""SELECT doc_id, size, text_crc32, grp, coalesce(lang_cell, 0)::INT AS x0, coalesce(source_cell, 0)::INT AS x1,
        ({size})::INT AS x2 FROM (SELECT doc_id, lang, source, octet_length(encode(coalesce(text, ''))) + 1 AS size,
        {CRC_SQL} AS text_crc32, md5(coalesce(text, '')) AS grp FROM documents, crc_table)
        LEFT JOIN langs USING (lang) LEFT JOIN sources USING (source)"""
    for q in (32, 16, 8, 4, 2):
        for axis in range(3):
            flip, swap = f"x{axis} & {q} <> 0", f"(xor(x0, x{axis}) & {q - 1})"
            new = f"CASE WHEN {flip} THEN xor(x0, {q - 1}) ELSE xor(x0, {swap}) END AS x0"
            if axis:
                new += f", CASE WHEN {flip} THEN x{axis} ELSE xor(x{axis}, {swap}) END AS x{axis}"
            rows = f"SELECT * REPLACE ({new}) FROM ({rows})"
    rows = f"SELECT * REPLACE (xor(x1, x0) AS x1, xor(xor(x2, x1), x0) AS x2) FROM ({rows})"
    parity = "0"
    for q in (32, 16, 8, 4, 2):
        parity = f"xor({parity}, CASE WHEN x2 & {q} <> 0 THEN {q - 1} ELSE 0 END)"
    rows = f"SELECT *, {parity} AS t FROM ({rows})"
    index = " + ".join(f"((xor(x{i}, t) >> {b}) & 1) * {2 ** (3 * b + 2 - i)}" for b in range(6) for i in range(3))
    return f"""WITH crc_table AS MATERIALIZED ({CRC_TABLE_SQL}), {cells.format("lang")}, {cells.format("source")}, placed AS (SELECT *, min({index}) OVER (PARTITION BY grp) AS cell FROM ({rows})),
        ranks AS (SELECT *, row_number() OVER (ORDER BY cell, grp, doc_id) - 1 AS r, count(*) OVER () AS n FROM placed),
        cut AS (SELECT *, r * 8 // n AS shard FROM ranks)
        SELECT doc_id, size, text_crc32, 'rows' AS law, shard::INT AS shard, r - (shard * n + 7) // 8 AS slot, NULL::INT AS grown_shard FROM cut"""


@query(_hilbert_sql())
def op7_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return hilbert.document_shards(table(spark, folder, "documents"), 8).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query()
def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), with_ids=False)


def _url_sql() -> str:
    """The rules, and both walks as one recursion over rounds, far beyond the point where they have settled."""
    fits = "(host = '{0}' OR ends_with(host, '.{0}')) AND starts_with(path, '{1}')"
    by_length = sorted(URL_RULES, key=lambda r: -len(r[0]))
    cases = [(fits.format(*((r.split("/", 1)[0]), "/" + r.split("/", 1)[1])), r, v) for r, v in by_length]
    rule = "CASE " + " ".join(f"WHEN {c} THEN '{r}'" for c, r, _ in cases) + " END"
    says = "CASE " + " ".join(f"WHEN {c} THEN '{v}'" for c, _, v in cases) + " END"
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    link = """(?i)<a\\s[^>]*?\\bhref\\s*=\\s*["'']?\\s*(?:https?:)?//([^/?#"''\\s>]+)"""
    url = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    steps = [
        f"""parts AS MATERIALIZED (SELECT page_id, {lower.format(f"coalesce(regexp_extract(url, '{url}', 1), '')")} AS host,
                coalesce(regexp_extract(url, '{url}', 2), '') AS path, coalesce(html, '') AS html FROM pages)""",
        f"rows AS MATERIALIZED (SELECT page_id, host, path, html, {rule} AS rule, {says} AS said FROM parts)",
        f"""edges AS MATERIALIZED (SELECT src, dst, count(*) AS links FROM
                (SELECT host AS src, {lower.format(f"unnest(regexp_extract_all(html, '{link}', 1))")} AS dst FROM rows WHERE host <> '')
                WHERE src <> dst GROUP BY ALL)""",
        """own AS (SELECT host, count(*) FILTER (said = 'allow') / count(*)::DOUBLE AS trust,
                count(*) FILTER (said = 'block') / count(*)::DOUBLE AS distrust FROM rows WHERE host <> '' GROUP BY host)""",
        f"""linked AS (SELECT host, {says} AS said FROM (SELECT DISTINCT dst AS host, '/' AS path FROM edges) WHERE host NOT IN (SELECT host FROM own))""",
        """seeds AS (SELECT * FROM own UNION ALL SELECT host, (said = 'allow')::INT::DOUBLE, (said = 'block')::INT::DOUBLE FROM linked)""",
        f"""shares AS (SELECT src, dst, {url_filter.DAMPING}::DOUBLE * links / sum(links) OVER (PARTITION BY src) AS share FROM edges)""",
        """moves AS MATERIALIZED (SELECT 'trust' AS kind, src AS here, dst AS there, share FROM shares
                UNION ALL SELECT 'distrust', dst, src, share FROM shares)""",
        f"""walk AS (SELECT 0 AS n, 'trust' AS kind, host, trust AS mass FROM seeds WHERE trust > 0
                UNION ALL SELECT 0, 'distrust', host, distrust FROM seeds WHERE distrust > 0
                UNION ALL SELECT n + 1, w.kind, there, sum(mass * share) FROM walk w JOIN moves m ON m.kind = w.kind AND here = host
                WHERE n < {SETTLED} GROUP BY n, w.kind, there)""",
        """scores AS (SELECT host, coalesce(sum(mass) FILTER (kind = 'trust'), 0) AS trust,
                coalesce(sum(mass) FILTER (kind = 'distrust'), 0) AS distrust FROM walk WHERE n > 0 GROUP BY host)""",
    ]
    return f"""WITH RECURSIVE {", ".join(steps)}
        SELECT page_id, r.host, path, rule,
               coalesce(said, CASE WHEN distrust >= {url_filter.FLOOR} AND distrust > trust THEN 'block' END, 'allow') AS verdict
        FROM rows r LEFT JOIN scores s ON s.host = r.host"""


@query(_url_sql())
def op9_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judged(table(spark, folder, "pages"), URL_RULES)


@query()
def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return leaks.marked(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("""
    WITH RECURSIVE cut AS (
        SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
               regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
    ), marks AS (
        SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
    ), judged AS (
        SELECT part, [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w), 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t),
                      regexp_matches(t, '[#$%&*|]'), coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)] AS fails,
               coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
        FROM cut LEFT JOIN marks USING (doc_id)
    ), groups AS MATERIALIZED (
        SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM judged GROUP BY part, fails
    ), orders AS (
        SELECT '' AS o UNION ALL
        SELECT o || x FROM orders, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x) WHERE NOT contains(o, x)
    ), places AS (
        SELECT o AS filter_order, i AS step, strpos('ABCDE', o[i]) AS own,
               list_transform(range(1, i), lambda j: strpos('ABCDE', o[j])) AS earlier
        FROM (SELECT o, unnest(range(1, 6)) AS i FROM orders WHERE length(o) = 5)
    ), applied AS (
        SELECT part, filter_order, step, own, n, good, toxic, fails[own] AS here,
               len(list_filter(earlier, lambda j: fails[j])) > 0 AS gone, len(list_filter(fails, lambda f: f)) AS failed
        FROM groups, places
    ), figures AS (
        SELECT part, filter_order, step, own,
               coalesce(sum(n) FILTER (NOT here AND NOT gone), 0) AS kept, coalesce(sum(n) FILTER (here AND NOT gone), 0) AS removed,
               coalesce(sum(n) FILTER (here AND gone), 0) AS redundant, coalesce(sum(n) FILTER (here AND failed = 1), 0) AS unique_fails,
               coalesce(sum(good) FILTER (here AND NOT gone), 0) AS good_lost, coalesce(sum(toxic) FILTER (here AND NOT gone), 0) AS toxic_lost
        FROM applied GROUP BY part, filter_order, step, own
    )
    SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
           unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
           (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM figures
""")
def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("""
    WITH cut AS (
        SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS u,
               list_transform(range(4), lambda i: ('0x' || substr(sha256('7:' || doc_id), 8 * i + 1, 8))::BIGINT) AS h FROM documents
    ), ends AS (
        SELECT doc_id, t, u, len(u) AS n, least(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS a,
               greatest(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS b,
               CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 100 THEN 'plain'
                    WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM cut
    ), parts AS (
        SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:], '') AS suffix FROM ends
    ), outputs AS (
        SELECT *, CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                  ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END AS o FROM parts
    ), places AS (SELECT *, strpos(o, '<P>') AS p, strpos(o, '<S>') AS s, strpos(o, '<M>') AS m FROM outputs)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars, sha256(o) AS output_sha256,
           sha256(CASE form WHEN 'plain' THEN o
                  WHEN 'psm' THEN substr(o, p + 3, s - p - 3) || substr(o, m + 3) || substr(o, s + 3, m - s - 3)
                  ELSE substr(o, p + 3, m - p - 3) || substr(o, m + 3) || substr(o, s + 3, p - s - 3) END) AS restored_sha256
    FROM places
""")
def op12_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    filled = infill.filled(infill.stored(table(spark, folder, "documents")))
    return infill.digests(filled).select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


@query()
def op13_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return pigeonring.grouped(table(spark, folder, "documents"))
