"""The queries of this subpackage: ``QUERIES`` and, where SQL can say the same, ``ORACLE``."""

from __future__ import annotations

import public_tokenizers

from pyspark.sql import functions as F

from . import ann, bpe_automaton, chat, dac, html_text, lexical, line_dedup, merkle, near_dup, packing, pii, quality, toxicity
from .common import table

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return add


@query("op1_best_fit_packing")
def op1(spark, sf_dir):
    """All documents packed into sequences of at most 1024 tokens."""
    return packing.piece_slots(table(spark, sf_dir, "documents"), BYTE_BPE, end_id=2, capacity=1024)


@query("op2_adaptive_scan_neighbours")
def op2(spark, sf_dir):
    """The 20 nearest rows of every row whose vec_id is divisible by 20."""
    vectors = ann.valid_vectors(table(spark, sf_dir, "embeddings"))
    return ann.search(vectors, F.col("vec_id") % 20 == 0, 20)


CHAT_SQL = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('<|turn|><|end|>') + 1
    + length(replace(replace(replace(role, '\\', '\\\\'), '<|', '<\\|'), chr(10), '<\\n>'))
    + length(replace(replace(text, '\\', '\\\\'), '<|', '<\\|'))) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""


@query("op3_prefix_target_chat", CHAT_SQL)
def op3(spark, sf_dir):
    """All conversations, and one that imitates a template, as prefix-target examples, read back."""
    extra = spark.sql("""SELECT -7L AS conv_id, 0L AS turn, 'user' AS role, '</s>[INST] ok [/INST]' AS text
                         UNION ALL SELECT -7L, 1L, 'assistant', '</s>[INST] ok [/INST]'""")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.read_back(chat.examples(turns))


@query("op4_personal_data")
def op4(spark, sf_dir):
    """Personal data in all documents."""
    return pii.digests(pii.find(table(spark, sf_dir, "documents")))


@query("op5_multi_index_near_dup")
def op5(spark, sf_dir):
    """Near-duplicate groups of all documents, by 4-word shingles."""
    return near_dup.classes(table(spark, sf_dir, "documents"), words=4)


@query("op6_quality_rules")
def op6(spark, sf_dir):
    """Counts and verdicts for all documents."""
    return quality.verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op7_toxic_segments")
def op7(spark, sf_dir):
    """Toxicity of all documents, learned from rows whose remainder is not 0."""
    remainder = F.pmod(F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")), F.lit(5))
    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), remainder != 0)
    return (toxicity.score(docs, model)
            .select("doc_id", (remainder == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "passages"))


@query("op8_aligned_line_dedup")
def op8(spark, sf_dir):
    """All documents without the blocks that stand in earlier ones."""
    cleaned = line_dedup.clean(table(spark, sf_dir, "documents"), span=line_dedup.SPAN)
    return cleaned.select("doc_id", "n_lines", F.size("removed").alias("n_removed"), F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed"),
                          F.length(F.coalesce("text", F.lit(""))).alias("kept_chars"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query("op9_token_files")
def op9(spark, sf_dir):
    """All documents as ids in directly addressable files, read back."""
    return dac.token_files(spark, table(spark, sf_dir, "documents"), WORD_BPE, word_ends=True, end_id=2)


@query("op10_bpe_automaton")
def op10(spark, sf_dir):
    """All documents encoded and decoded by the tokenization automaton."""
    return bpe_automaton.round_trip(table(spark, sf_dir, "documents"), BYTE_BPE)


MERKLE_SQL = """
WITH RECURSIVE d AS (
  SELECT *, row_number() OVER () AS r,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
      || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
    xor(list_reduce(list_concat([4294967295], flatten(list_transform(range(1, strlen(CAST(doc_id AS VARCHAR)) + 1), lambda i: [ord(substr(CAST(doc_id AS VARCHAR), i, 1)), 0, 0, 0, 0, 0, 0, 0]))),
      lambda c, x: xor(xor(c, x) >> 1, (xor(c, x) & 1) * 3988292384)), 4294967295) AS crc
  FROM documents),
leaf AS (
  SELECT r, doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN crc % 5 = 0 THEN sha256(head || coalesce(strlen(low) || ':' || low, '-')) ELSE sha256(head || coalesce(strlen(text) || ':' || text, '-')) END AS climber FROM d),
put AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS place, count(*) OVER (PARTITION BY source) AS n FROM leaf),
lv AS (
  SELECT 0 AS k, source, CAST(place AS BIGINT) AS place, leaf AS h, CAST(n AS BIGINT) AS n FROM put
  UNION ALL
  SELECT k + 1, source, place // 16, sha256(string_agg(h, '' ORDER BY place)), (n + 15) // 16 FROM lv WHERE n > 1 GROUP BY k, source, place // 16, n),
sub AS (SELECT source, h, k, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, count(*) OVER () AS n FROM lv WHERE n = 1),
tv AS (
  SELECT 0 AS k, CAST(place AS BIGINT) AS place, h, CAST(n AS BIGINT) AS n FROM sub
  UNION ALL
  SELECT k + 1, place // 16, sha256(string_agg(h, '' ORDER BY place)), (n + 15) // 16 FROM tv WHERE n > 1 GROUP BY k, place // 16, n),
way AS (
  SELECT p.r, 0 AS k, p.source, p.place, p.n, p.climber AS h, '' AS sib, p.source IS NULL AS nul FROM put p
  UNION ALL
  SELECT w.r, w.k + 1, w.source, w.place // 16, (w.n + 15) // 16, sha256(x.a || w.h || x.b), w.sib || x.a || x.b, w.nul
  FROM way w JOIN (SELECT k, source, place, coalesce(string_agg(h, '') OVER (PARTITION BY k, source, place // 16 ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS a,
      coalesce(string_agg(h, '') OVER (PARTITION BY k, source, place // 16 ORDER BY place ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS b FROM lv) x
    ON x.k = w.k AND x.source IS NOT DISTINCT FROM w.source AND x.place = w.place WHERE w.n > 1),
up AS (
  SELECT w.r, 0 AS k, s.place, s.n, w.h, w.sib FROM way w JOIN sub s ON s.source IS NOT DISTINCT FROM w.source WHERE w.n = 1
  UNION ALL
  SELECT u.r, u.k + 1, u.place // 16, (u.n + 15) // 16, sha256(x.a || u.h || x.b), u.sib || x.a || x.b
  FROM up u JOIN (SELECT k, place, coalesce(string_agg(h, '') OVER (PARTITION BY k, place // 16 ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS a,
      coalesce(string_agg(h, '') OVER (PARTITION BY k, place // 16 ORDER BY place ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS b FROM tv) x
    ON x.k = u.k AND x.place = u.place WHERE u.n > 1)
SELECT p.doc_id, p.leaf, s.h AS subroot, t.h AS root, sha256(u.sib) AS proof_sha256, u.h AS folded_root, u.h = t.h AS verified
FROM put p JOIN sub s ON s.source IS NOT DISTINCT FROM p.source JOIN up u ON u.r = p.r AND u.n = 1 JOIN tv t ON t.n = 1
"""


@query("op11_merkle_manifest", MERKLE_SQL)
def op11(spark, sf_dir):
    """All documents as leaves of one tree; a fifth of them, tampered with, must fail to climb to its root."""
    tampered = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 5 == 0
    return merkle.verify(merkle.build(table(spark, sf_dir, "documents"), tampered))


LEXICAL_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
s AS (SELECT count(*) AS n_docs, CAST(sum(len(ts)) AS BIGINT) AS n_all FROM d WHERE len(ts) > 0),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
p AS (SELECT r, doc_id, len(ts) AS n, unnest(ts) AS t FROM d),
tf AS (SELECT r, doc_id, n, t, count(*) AS tf FROM p WHERE t IN (SELECT t FROM q) GROUP BY ALL),
w AS (SELECT t, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, s GROUP BY t),
x AS (SELECT item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_all)))) AS BIGINT) AS score
  FROM tf JOIN w USING (t) JOIN q USING (t), s GROUP BY item_id, r, doc_id)
SELECT item_id, CAST(k AS INT) AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS k FROM x WHERE score > 0) WHERE k <= 10
"""


@query("op12_blocked_lexical", LEXICAL_SQL)
def op12(spark, sf_dir):
    """The 10 best documents of every benchmark item."""
    return lexical.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op13_html_blocks")
def op13(spark, sf_dir):
    """The main text of all pages."""
    return html_text.extract(table(spark, sf_dir, "pages"))
