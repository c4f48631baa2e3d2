"""The registered queries of the corpus operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm import bpe, exact, ivf, langid, lines, minhash, packing, ranking, repair, secrets, sharding, suffix, toxicity
from cohortlens.llm.common import stored, table

VOCABULARY = "byte_bpe_50k.json"


def vocabulary_path() -> str:
    """Where the public tokenizer's file lies on this machine and, by the same installation, on the executors."""
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def held_out(modulus: int, rest: int):
    """Rows that no model learns from: crc32 of the id as text leaves ``rest``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == rest


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents"), held_out(4, 2)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held)
    return toxicity.score(docs, model).withColumn("held_out", held).select("doc_id", "held_out", "score", "predicted")


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.equal_texts(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = lines.remove_boilerplate(table(spark, sf_dir, "documents"), counts=True)
    return cleaned.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary_path())


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs, ~held_out(3, 1))
    return (langid.identify(docs, model).withColumn("held_out", held_out(3, 1))
            .select("doc_id", "held_out", "lang_pred", "score", "rejected"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.findings(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "token_no", F.length("secret").alias("length"), "key_word", "probability", "is_secret")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def op9_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ivf.near_vectors(table(spark, sf_dir, "embeddings"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary_path())


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = stored(ranking.build_index(table(spark, sf_dir, "documents")), "ranking-index")
    return ranking.search(index, table(spark, sf_dir, "benchmark"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return repair.Repair(repair.damage(turns)).report(turns)


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards_by_bytes(table(spark, sf_dir, "documents"))


#: Terms of ``text``, only A-Z lower-cased.
_TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""


def _edited(value: str, cost: str, edit: str) -> str:
    """SQL for a repair grown by an edit; twelve digits of cost lead its audit, so that texts compare as (cost, audit)."""
    return f"(lpad(CAST(CAST(left({value}, 12) AS BIGINT) + {cost} AS VARCHAR), 12, '0') || substr({value}, 13) || '{edit}')"


def _repair_sql() -> str:
    """Cheapest repairs turn by turn (start n, system s, user u, pair a), then the edits applied to the turns."""
    def insert(place: str) -> str:
        return _edited(place, "2", "I")

    def kept(initial: str, places: str) -> str:
        return ", ".join(f"CASE WHEN whole AND r = '{initial}' THEN {_edited('v' + p, 'more', 'K')} END" for p in places)

    def rerole(places: str) -> str:
        return ", ".join(f"CASE WHEN whole THEN {_edited('v' + p, '2 + more', 'R')} END" for p in places)

    def delete(place: str) -> str:
        return _edited("v" + place, "3", "D")

    shift = "xor(c, b) >> 1"
    return f"""
        WITH RECURSIVE named AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
        lots AS (SELECT *, xor(list_reduce(flatten(list_transform(string_split(name, ''),
                     lambda x: [CAST(ord(x) AS BIGINT), 0, 0, 0, 0, 0, 0, 0])),
                     lambda c, b: CASE WHEN xor(c, b) & 1 = 1 THEN xor({shift}, 3988292384) ELSE {shift} END,
                     CAST(4294967295 AS BIGINT)), 4294967295) % 20 AS lot FROM named),
        damaged AS (SELECT conv_id, turn, CASE lot WHEN 4 THEN 'user' ELSE role END AS role,
                           CASE lot WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
                           unnest(CASE lot WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM lots WHERE lot <> 0),
        placed AS (SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') AS key, left(role, 1) AS r,
                          row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM damaged),
        faulty AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1
                                  WHEN row_number() OVER (PARTITION BY key, role, text ORDER BY i) > 1 THEN 2
                                  WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 3 ELSE 0 END AS fault,
                          lag(r) OVER (PARTITION BY key ORDER BY i) || r AS pair FROM placed),
        turns AS (SELECT *, fault IN (0, 3) AS whole, CAST(fault = 3 AS BIGINT) AS more FROM faulty),
        figures AS (SELECT key, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) AS n,
                           count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
                           count(*) FILTER (fault = 3) AS truncated,
                           count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM turns GROUP BY key),
        steps AS (
            SELECT key, CAST(0 AS BIGINT) AS i, '000000000000' AS vn, CAST(NULL AS VARCHAR) AS vs,
                   '000000000002I' AS vu, '000000000004II' AS va FROM figures
            UNION ALL
            SELECT key, i, vn, vs, vu, least(va, {insert("vu")}) AS va FROM (
                SELECT key, i, vn, vs, least(vu, {insert("vn")}, {insert("vs")}, {insert("va")}) AS vu, va FROM (
                    SELECT key, t.i, {delete("n")} AS vn, least({delete("s")}, {kept("s", "n")}) AS vs,
                           least({delete("u")}, {kept("u", "nsa")}, {rerole("nsa")}) AS vu,
                           least({delete("a")}, {kept("a", "u")}, {rerole("u")}) AS va
                    FROM steps JOIN turns t USING (key) WHERE t.i = steps.i + 1))),
        best AS (SELECT key, least(vn, va) AS v FROM steps JOIN figures USING (key) WHERE i = n),
        audits AS (SELECT key, CAST(left(v, 12) AS BIGINT) AS cost, substr(v, 13) AS audit FROM best),
        writing AS (
            SELECT key, audit, 0 AS k, CAST(0 AS BIGINT) AS i, 'n' AS place, CAST([] AS VARCHAR[]) AS lines FROM audits
            UNION ALL
            SELECT key, audit, k + 1, upto, CASE e WHEN 'D' THEN place WHEN 'K' THEN r ELSE CASE place WHEN 'u' THEN 'a' ELSE 'u' END END,
                   CASE e WHEN 'D' THEN lines ELSE list_append(lines, CASE e WHEN 'K' THEN role ELSE
                       CASE place WHEN 'u' THEN 'assistant' ELSE 'user' END END || ':' || CASE e WHEN 'I' THEN '' ELSE text END) END
            FROM (SELECT w.key, w.audit, w.k, w.place, w.lines, w.upto, w.e, t.role, t.r, t.text
                  FROM (SELECT *, substr(audit, k + 1, 1) AS e, i + CAST(substr(audit, k + 1, 1) <> 'I' AS BIGINT) AS upto
                        FROM writing WHERE k < len(audit)) w LEFT JOIN turns t ON t.key = w.key AND t.i = w.upto)),
        written AS (SELECT key, sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256 FROM writing WHERE k = len(audit)),
        ids AS (SELECT DISTINCT conv_id, coalesce(CAST(conv_id AS VARCHAR), ' ') AS key FROM conversations)
        SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
               coalesce(audit, '') AS audit, coalesce(repaired_sha256, sha256('')) AS repaired_sha256
        FROM ids LEFT JOIN figures USING (key) LEFT JOIN audits USING (key) LEFT JOIN written USING (key)"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_minhash": op3_minhash,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_line_dedup": op5_line_dedup,
    "op6_bpe": op6_bpe,
    "op7_language_id": op7_language_id,
    "op8_secret_scan": op8_secret_scan,
    "op9_multi_index": op9_multi_index,
    "op10_packing": op10_packing,
    "op11_ranked_search": op11_ranked_search,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_sharding": op13_sharding,
    "pipeline": pipeline,
}

ORACLES: dict[str, str] = {
    "op4_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
    "op9_multi_index": """
        WITH RECURSIVE units AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
            WHERE embedding IS NOT NULL),
        normed AS (SELECT vec_id, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS v FROM units
                   WHERE list_dot_product(v, v) > 0 AND isfinite(list_dot_product(v, v))),
        links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM normed a JOIN normed b ON a.vec_id <> b.vec_id
                  WHERE list_dot_product(a.v, b.v) >= 0.95),
        reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
        found AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
        counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
        SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
        FROM found LEFT JOIN counts USING (vec_id)""",
    "op5_line_dedup": """
        WITH parts AS (SELECT doc_id, source, string_split(text, chr(10)) AS parts FROM documents),
        lines AS (SELECT doc_id, coalesce(source, '') AS site, CAST(i AS INTEGER) AS line_no,
                         trim(parts[i], chr(32) || chr(9) || chr(13)) AS line
                  FROM parts, unnest(range(1, len(parts) + 1)) AS t(i)),
        spread AS (SELECT line, min((doc_id, line_no)) AS first FROM lines WHERE line <> ''
                   GROUP BY line HAVING count(DISTINCT site) >= 10),
        taken AS (SELECT doc_id, list(line_no) AS taken FROM lines JOIN spread USING (line)
                  WHERE (doc_id, line_no) <> first GROUP BY doc_id)
        SELECT doc_id, coalesce(len(parts), 0) AS n_lines, coalesce(len(taken), 0) AS n_removed,
               sha256(CASE WHEN taken IS NULL THEN coalesce(array_to_string(parts, chr(10)), '')
                           ELSE coalesce(array_to_string(list_transform(list_filter(range(1, len(parts) + 1),
                                lambda i: NOT list_contains(taken, i)), lambda i: parts[i]), chr(10)), '') END) AS kept_sha256
        FROM parts LEFT JOIN taken USING (doc_id)""",
    "op11_ranked_search": f"""
        WITH found AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
        often AS (SELECT doc_id, term, count(*) AS tf FROM found GROUP BY ALL),
        sizes AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM often GROUP BY doc_id),
        whole AS (SELECT count(*) AS documents, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
        norms AS (SELECT doc_id, 75 + 25 * n * documents // terms AS m FROM sizes, whole),
        weights AS (SELECT term, CAST(floor(1000 * ln((2 * documents + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
                    FROM often, whole GROUP BY term, documents),
        asked AS (SELECT item_id, term, count(*) AS c
                  FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
        scores AS (SELECT item_id, doc_id, CAST(sum(c * w * (1000000000 * tf // (1000 * tf + 12 * m))) AS BIGINT) AS score
                   FROM asked JOIN weights USING (term) JOIN often USING (term) JOIN norms USING (doc_id) GROUP BY ALL)
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
        FROM scores WHERE score > 0 QUALIFY rank <= 20""",
    "op12_conversation_repair": _repair_sql(),
}
