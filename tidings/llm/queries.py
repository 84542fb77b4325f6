"""The named queries of this subpackage: thin digests of its operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.llm import decontaminate, imatch, lines, lm, mixing, phrases, quality, sharding, simhash, spelling, substrings, urls, warc
from tidings.session import materialize
from tidings.sources.tables import table


def op1_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op2_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op3_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.compare_edits(table(spark, sf_dir, "documents"))


def op4_quality_rff(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", (quality.remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "score", "predicted")


def op5_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_lm_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a document and a benchmark item found in it."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = materialize(mixing.sized(table(spark, sf_dir, "documents")), "sizes")
    drawn = mixing.copies(sizes, mixing.source_targets(sizes))
    return drawn.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op9_sharding_bfd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup(table(spark, sf_dir, "documents")).drop("spans")


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: lines before, lines dropped, digest of what is left."""
    return lines.dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per word: its form, the end of its forms and its near words."""
    return spelling.variants(spelling.vocabulary(table(spark, sf_dir, "documents")))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per language: its best collocations."""
    return phrases.mine(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_url_rules, op2_warc_salvage, op3_imatch, op4_quality_rff, op5_simhash_trie, op6_lm_backoff, op7_decontaminate,
                                   op8_mixing, op9_sharding_bfd, op10_substrings, op11_line_dedup, op12_spelling_variants, op13_phrases)}
ORACLES: dict[str, str] = {}

MIXED = r"""
WITH sized AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
src AS (SELECT source, sum(size)::BIGINT AS source_size, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w
        FROM sized GROUP BY source),
caps AS (SELECT *, 2.0::DOUBLE * source_size AS cap FROM src),
run AS (SELECT *, coalesce(sum(cap) OVER lower, 0) AS used, sum(w) OVER () - coalesce(sum(w) OVER lower, 0) AS free,
               1.5::DOUBLE * (SELECT sum(size) FROM sized) AS budget
        FROM caps WINDOW lower AS (ORDER BY cap / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT max((budget - used) / free) AS level FROM run),
goal AS (SELECT source, source_size, least(cap, coalesce(level, 0) * w) AS target FROM caps, level),
rated AS (SELECT doc_id, size, g.source_size, target, CASE WHEN g.source_size > 0 THEN target / g.source_size ELSE 0 END AS rate,
                 ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::UBIGINT::DOUBLE / 4503599627370496 AS u
          FROM sized s JOIN goal g ON s.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target, (size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken FROM rated
"""

ORACLES["op8_mixing"] = MIXED

LINES = r"""
WITH cut AS (SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
line AS (SELECT doc_id, r, unnest(l) AS line, unnest(range(len(l))) AS pos FROM cut),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM line),
held AS (SELECT DISTINCT k, doc_id FROM keyed WHERE length(k) >= 20),
common AS (SELECT k, max(doc_id) AS last_doc FROM held GROUP BY k HAVING count(*) >= 3),
marked AS (SELECT doc_id, r, pos, line, common.k IS NOT NULL AND doc_id IS DISTINCT FROM last_doc AS gone FROM keyed LEFT JOIN common USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id, r
"""

# crc32 byte by byte from its polynomial; near words by equal remainders after one deletion
SPELLING = r"""
WITH RECURSIVE bit AS (SELECT i AS b, i::BIGINT AS c, 0 AS step FROM range(256) t(i)
  UNION ALL SELECT b, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, step + 1 FROM bit WHERE step < 8),
tab AS (SELECT list(c ORDER BY b) AS t FROM bit WHERE step = 8),
run AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS w FROM documents),
low AS (SELECT doc_id, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, count(*) AS n FROM run WHERE length(w) >= 7 GROUP BY ALL),
hexed AS (SELECT *, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || w)) AS x FROM low),
crc AS (SELECT w, n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(range(length(x) // 2), lambda i: ('0x' || substr(x, (2 * i + 1)::BIGINT, 2))::BIGINT)),
    lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]))) AS h FROM hexed, tab),
slip AS (SELECT CASE WHEN h % 31 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, n FROM crc),
vocab AS (SELECT word, sum(n)::BIGINT AS n FROM slip WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cut AS (SELECT DISTINCT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS d FROM (SELECT word, n, unnest(range(length(word))) AS i FROM vocab)),
less AS (SELECT DISTINCT word, n, d FROM cut),
near AS (SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.i = b.i AND a.d = b.d AND a.word <> b.word
  UNION SELECT l.word, v.word, v.n FROM less l JOIN vocab v ON l.d = v.word
  UNION SELECT v.word, l.word, l.n FROM less l JOIN vocab v ON l.d = v.word),
best AS (SELECT word, count(*) AS n_near, min_by(struct_pack(w := other, n := other_n), struct_pack(a := -other_n, b := other)) AS b FROM near GROUP BY word),
formed AS (SELECT word, CASE WHEN b.n >= 10 * v.n THEN b.w END AS form, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN b.n >= 10 * v.n THEN b.n END AS form_n
  FROM vocab v LEFT JOIN best USING (word)),
walk AS (SELECT word, word AS at, form AS next FROM formed UNION ALL SELECT walk.word, walk.next, f.form FROM walk JOIN formed f ON f.word = walk.next)
SELECT word, form, walk.at AS root, n, n_near, form_n FROM formed JOIN walk USING (word) WHERE walk.next IS NULL
"""

PHRASES = r"""
WITH piece AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
worded AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM piece),
gram AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM worded, range(1, 6) t(k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, count(*) AS n FROM gram GROUP BY ALL),
total AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND n >= 100),
cut AS (SELECT lang, phrase, a, c, array_to_string(w[1:c], ' ') AS p1, array_to_string(w[c + 1:], ' ') AS p2 FROM (SELECT *, unnest(range(1, k)) AS c FROM cand)),
scored AS (SELECT cut.lang, cut.phrase, a, c, x.n AS l, y.n AS r, total.n, ((1000::HUGEINT * a * total.n) // (x.n::HUGEINT * y.n))::BIGINT AS score
  FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = p1 JOIN f y ON y.lang = cut.lang AND y.phrase = p2 JOIN total ON total.lang = cut.lang),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
sub AS (SELECT lang, array_to_string(w[i:j], ' ') AS phrase, max(a) AS longer FROM (SELECT lang, w, a, i, unnest(range(i + 1, k + 1)) AS j, k FROM
  (SELECT lang, w, a, k, unnest(range(1, k)) AS i FROM cand)) WHERE j - i + 1 < k GROUP BY ALL),
kept AS (SELECT lowest.* FROM lowest LEFT JOIN sub USING (lang, phrase) WHERE longer IS NULL OR longer < a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM kept
QUALIFY rank <= 2000
"""

ORACLES |= {"op11_line_dedup": LINES, "op12_spelling_variants": SPELLING, "op13_phrases": PHRASES}
