"""A small vocabulary against SQL: merges one at a time in a recursive query, and texts encoded by them."""

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import tokens as k
from corpusloom.plans.sequences import _PATTERN_SQL, MAX_LENGTH, SIMPLE_PATTERN, WORDS_SQL
from tests.oracle import connect, differences

FOLDER = "/root/testdata/sf0.001"
SIZE = 320

# Training by the definition, one merge at a time. A word is a string of one character per symbol, 256 + id. Bytes that are
# printable stand for themselves, the others for the code points from 256 on; ids follow the six reserved tokens in the
# order of these characters.
BPE_SQL = f"""
shown AS (
  SELECT b, CASE WHEN plain THEN chr(b::INT) ELSE chr(255 + (row_number() OVER (PARTITION BY plain ORDER BY b))::INT) END AS name
  FROM (SELECT b, b BETWEEN 33 AND 126 OR (b BETWEEN 161 AND 255 AND b <> 173) AS plain FROM range(256) t(b))
),
base AS MATERIALIZED (SELECT b, name, 5 + (row_number() OVER (ORDER BY unicode(name)))::INT AS id FROM shown),
{WORDS_SQL},
counts AS (SELECT word, count(*) AS freq FROM words GROUP BY word),
hexed AS (SELECT word, freq, regexp_extract_all(hex(encode(word)), '..') AS h FROM counts),
coded AS (SELECT word, freq, ('0x' || unnest(h))::INT AS b, unnest(range(0, len(h))) AS i FROM hexed),
begun AS MATERIALIZED (SELECT word, freq, string_agg(chr(256 + id), '' ORDER BY i) AS syms FROM coded JOIN base USING (b) GROUP BY word, freq),
states AS (
  SELECT 0 AS step, NULL::VARCHAR AS pair, word, freq, syms FROM begun
  UNION ALL
  SELECT s.step + 1, t.pair, s.word, s.freq, replace(s.syms, t.pair, chr(256 + 262 + s.step))
  FROM states s, (
    SELECT pair FROM (
      SELECT substr(syms, i::INT, 2) AS pair, sum(freq) AS n
      FROM (SELECT syms, freq, unnest(range(1, length(syms))) AS i FROM states) GROUP BY 1)
    WHERE n >= {k.MIN_FREQUENCY} ORDER BY n DESC, pair LIMIT 1) t
  WHERE s.step < {SIZE - 262}
),
merges AS MATERIALIZED (SELECT DISTINCT step, pair FROM states WHERE step > 0),
names AS (
  SELECT 0 AS step, NULL::VARCHAR AS lft, NULL::VARCHAR AS rgt, (SELECT map_from_entries(list((chr(256 + id), name))) FROM base) AS m
  UNION ALL
  SELECT g.step, m[substr(g.pair, 1, 1)], m[substr(g.pair, 2, 1)],
    map_concat(m, MAP {{chr(256 + 261 + g.step): m[substr(g.pair, 1, 1)] || m[substr(g.pair, 2, 1)]}})
  FROM names n JOIN merges g ON g.step = n.step + 1
)"""

MERGES_SQL = f"""
WITH RECURSIVE {BPE_SQL}
SELECT (step - 1)::INT AS rank, lft AS "left", rgt AS "right" FROM names WHERE step > 0
"""

VOCABULARY_SQL = f"""
WITH RECURSIVE {BPE_SQL}
SELECT token, id::INT AS id, true AS special FROM (VALUES
  ('<|pad|>', 0), ('<|bos|>', 1), ('<|end|>', 2), ('<|user|>', 3), ('<|assistant|>', 4), ('<|system|>', 5)) t(token, id)
UNION ALL SELECT name, id, false FROM base
UNION ALL SELECT lft || rgt, (261 + step)::INT, false FROM names WHERE step > 0
"""

ENCODED_SQL = f"""
WITH RECURSIVE {BPE_SQL},
final AS (SELECT word, syms FROM states WHERE step = (SELECT max(step) FROM states)),
split AS (SELECT doc_id, regexp_extract_all(text, {_PATTERN_SQL}) AS w FROM documents),
listed AS (SELECT doc_id, unnest(w) AS word, unnest(range(0, len(w))) AS i FROM split),
joined AS (SELECT doc_id, string_agg(syms, '' ORDER BY i) AS syms FROM listed JOIN final USING (word) GROUP BY doc_id)
SELECT doc_id, length(syms) AS n_tokens,
  list_aggregate(list_transform(string_split(substr(syms, 1, {MAX_LENGTH}), ''), lambda c: unicode(c) - 256), 'string_agg', ',') AS input_ids
FROM joined
"""


@pytest.fixture(scope="module")
def small(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").repartition(8)
    return docs, k.train_vocabulary(docs, vocab_size=SIZE, pattern=SIMPLE_PATTERN)


def encoded(docs, learned):
    rows = k.encode(docs, learned, MAX_LENGTH, keep=["doc_id"], pattern=SIMPLE_PATTERN)
    return rows.select("doc_id", "n_tokens", F.array_join(F.col("input_ids").cast("array<string>"), ",").alias("input_ids"))


def test_against_sql(spark, small):
    docs, learned = small
    assert len(learned.merges) == SIZE - 262
    con = connect(FOLDER)
    for frame, sql in (
        (learned.merges_frame(spark), MERGES_SQL),
        (learned.vocab_frame(spark), VOCABULARY_SQL),
        (encoded(docs, learned), ENCODED_SQL),
    ):
        assert differences(lambda *_: frame, sql, spark, FOLDER, con) == []
