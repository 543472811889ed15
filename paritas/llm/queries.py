"""One query for each operator, over its whole table with production settings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paritas.llm import (
    decontamination,
    forest,
    language,
    packing,
    paragraphs,
    rans,
    repair,
    repetition,
    secrets,
    sharding,
    spelling,
    tournament,
    warc,
)
from paritas.llm.common import table

#: Path of the tokenizer file the queries use; a parameter of the operators.
TOKENIZER, BYTE_TOKENIZER = "word_bpe_49k.json", "byte_bpe_50k.json"
END_ID = 1


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.repeats(table(spark, sf_dir, "documents"))


def op2_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.groups(table(spark, sf_dir, "documents"), k=2)


def op3_secret_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.scan(docs).select("doc_id", "secrets.n_assign", "secrets.n_access",
                                     "secrets.n_hex", "secrets.base_sha256", "secrets.spans")


def op4_suffix_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return repetition.judge(docs).select("doc_id", *[f"quality.{c}" for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "kept", "longest_repeat")])


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), END_ID)


def op7_permutation_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(table(spark, sf_dir, "documents").select("doc_id"))


def op8_rans_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rans.round_trip(table(spark, sf_dir, "documents"), tokenizer_path(), END_ID)


def op9_qgram_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each place where a document holds a benchmark item."""
    return decontamination.matches(table(spark, sf_dir, "documents"),
                                   table(spark, sf_dir, "benchmark"))


def op10_hyperdimensional_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    profiles = language.learn(docs, fold != 0)
    held = docs.withColumn("held_out", F.coalesce(fold == 0, F.lit(True))).drop("lang")
    return language.predict(held, profiles).select("doc_id", "held_out", "language.lang_pred",
                                                   "language.score")


def op11_viterbi_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(repair.damaged(table(spark, sf_dir, "conversations")))


def op12_tournament_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tournament.pack(table(spark, sf_dir, "documents"), tokenizer_path(BYTE_TOKENIZER), END_ID)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_paragraph_dedup": op1_paragraph_dedup,
    "op2_lsh_forest": op2_lsh_forest,
    "op3_secret_automaton": op3_secret_automaton,
    "op4_suffix_repetition": op4_suffix_repetition,
    "op5_warc": op5_warc,
    "op6_pattern_packing": op6_pattern_packing,
    "op7_permutation_sharding": op7_permutation_sharding,
    "op8_rans_tokens": op8_rans_tokens,
    "op9_qgram_decontamination": op9_qgram_decontamination,
    "op10_hyperdimensional_language": op10_hyperdimensional_language,
    "op11_viterbi_repair": op11_viterbi_repair,
    "op12_tournament_packing": op12_tournament_packing,
    "op13_spelling_variants": op13_spelling_variants,
}

_HELD = sharding.lookup_table([f"shard-{i:05d}" for i in range(sharding.SHARDS)])

# crc32 by its table of 256 entries, a byte at a time: DuckDB has no function for it
_CRC_TABLE = """crc_table AS (SELECT list(v ORDER BY i) AS t FROM (
          SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k:
            CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
          FROM range(256) r(i)))"""


def _crc32(text: str) -> str:
    """SQL for crc32 of the UTF-8 bytes of a text; needs ``crc_table``."""
    return f"""xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
            range(1, 1 + strlen({text})), lambda i: ('0x' || substr(hex(encode({text})), 2 * i - 1, 2))::BIGINT)),
            lambda c, b: xor(t[1 + (xor(c, b) & 255)], c >> 8)), 4294967295)"""


ORACLE: dict[str, str] = {
    "op5_warc": """
        WITH own AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
        told AS (SELECT page_id, octet_length(payload) AS payload_bytes,
          sha1(payload) AS payload_digest FROM own),
        best AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS stored FROM told)
        SELECT page_id, payload_bytes, payload_digest,
          CASE WHEN payload_bytes >= 1000 AND page_id <> stored THEN 'revisit' ELSE 'response' END
            AS record_type,
          CASE WHEN payload_bytes >= 1000 AND page_id <> stored THEN stored END AS refers_to
        FROM best""",
    # the table is checked against a plain filling in the tests; this checks each row's placement
    "op7_permutation_sharding": f"""
        WITH held AS (SELECT {_HELD} AS owner),
        slots AS (SELECT doc_id,
          CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT)
            % {sharding.SLOTS} AS slot FROM documents)
        SELECT doc_id, slot, CAST(owner[slot + 1] AS INTEGER) AS shard FROM slots, held""",
    "op11_viterbi_repair": f"""
        WITH RECURSIVE {_CRC_TABLE},
        keyed AS (SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':'
          || coalesce(CAST(turn AS VARCHAR), ' ') AS named FROM conversations),
        kinds AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
          {_crc32("named")} % 20 AS kind FROM keyed, crc_table),
        rows_ AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
          CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END
            AS text, unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
          FROM kinds),
        placed AS (SELECT *, row_number() OVER o AS i, lag(left(role, 1)) OVER o AS before
          FROM rows_ WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text))),
        faulty AS (SELECT *, rtrim(text, e' \t\n\x0B\x0C\r') AS body,
          row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen FROM placed),
        judged AS (SELECT *, left(role, 1) AS initial, CASE WHEN body = '' THEN 'b' WHEN seen THEN 'd'
          WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault FROM faulty),
        figures AS (SELECT conv_id, max(i) AS n,
          coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
          count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
          count(*) FILTER (fault = 't') AS truncated,
          count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au'))
            AS illegal FROM judged GROUP BY conv_id),
        -- up to three insertions from each state ('' nothing yet, or the last initial)
        steps AS (SELECT * FROM (VALUES ('', 'u', 'user'), ('s', 'u', 'user'),
          ('u', 'a', 'assistant'), ('a', 'u', 'user')) v(was, now, said)),
        added AS (
          SELECT was AS f, was AS g, '' AS marks, []::VARCHAR[] AS lines FROM steps
          UNION SELECT was, now, 'I', [said || ':'] FROM steps
          UNION SELECT x.was, y.now, 'II', [x.said || ':', y.said || ':']
          FROM steps x JOIN steps y ON y.was = x.now),
        -- ways through the first i rows: for each last initial the least (cost, audit)
        ways AS (
          SELECT conv_id, CAST(0 AS BIGINT) AS i, '' AS last,
            {{'cost': CAST(0 AS BIGINT), 'audit': '', 'lines': []::VARCHAR[]}} AS way FROM figures
          UNION ALL
          SELECT conv_id, i, last, min(way) AS way FROM (
            SELECT j.conv_id, j.i, CASE e.edit WHEN 'D' THEN a.g WHEN 'K' THEN j.initial ELSE s.now END
              AS last, {{'cost': w.way.cost + 5 * length(a.marks) + e.price
                + CASE WHEN j.fault = 't' AND e.edit <> 'D' THEN 5 ELSE 0 END,
              'audit': w.way.audit || a.marks || e.edit,
              'lines': w.way.lines || a.lines || CASE e.edit WHEN 'D' THEN []::VARCHAR[]
                WHEN 'K' THEN [j.role || ':' || j.text] ELSE [s.said || ':' || j.text] END}} AS way
            FROM ways w JOIN judged j ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.i = w.i + 1
            JOIN added a ON a.f = w.last JOIN steps s ON s.was = a.g
            JOIN (VALUES ('D', 2), ('K', 0), ('R', 1)) e(edit, price) ON e.edit = 'D'
              OR (j.fault NOT IN ('b', 'd') AND (e.edit = 'R'
                OR (a.g || ':' || j.initial IN (':s', ':u', 's:u', 'u:a', 'a:u')))))
          GROUP BY conv_id, i, last),
        ended AS (SELECT f.conv_id, min({{'cost': w.way.cost + 5 * length(a.marks),
            'audit': w.way.audit || a.marks, 'lines': w.way.lines || a.lines}}) AS best
          FROM figures f JOIN ways w ON w.conv_id IS NOT DISTINCT FROM f.conv_id AND w.i = f.n
          JOIN added a ON a.f = w.last AND a.g IN ('', 'a') GROUP BY f.conv_id)
        SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
          coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
          coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0) AS cost,
          coalesce(best.audit, '') AS audit,
          sha256(coalesce(array_to_string(best.lines, e'\n'), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) c
        LEFT JOIN figures f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
        LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM c.conv_id""",
    "op13_spelling_variants": f"""
        WITH RECURSIVE {_CRC_TABLE},
        runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(
          translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents),
        counted AS (SELECT id, run, count(*) AS n FROM runs GROUP BY ALL),
        hashed AS (SELECT run, n, {_crc32("(id || ':' || run)")} AS h FROM counted, crc_table
          WHERE length(run) >= 6),
        mended AS (SELECT n, CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run))
          || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed),
        words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM mended WHERE length(word) >= 6
          GROUP BY word HAVING sum(n) >= 5),
        cut AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
          FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
        pairs AS (
          SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM cut a JOIN cut b
            ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
          UNION SELECT a.word, a.n, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
          UNION SELECT b.word, b.n, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS k,
          count(*) OVER (PARTITION BY word) AS n_near FROM pairs),
        known AS (SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near,
          CASE WHEN r.near_n >= 5 * w.n THEN r.near END AS form,
          CASE WHEN r.near_n >= 5 * w.n THEN r.near_n END AS form_n
          FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.k = 1),
        chains AS (SELECT word, word AS root, 0 AS steps FROM known
          UNION ALL SELECT c.word, k.form, c.steps + 1 FROM chains c JOIN known k ON k.word = c.root
          WHERE k.form IS NOT NULL)
        SELECT k.word, form, arg_max(root, steps) AS root, n, n_near, form_n
        FROM known k JOIN chains c ON c.word = k.word GROUP BY ALL""",
}
