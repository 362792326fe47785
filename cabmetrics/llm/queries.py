"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabmetrics.session import scratch_path

from .chat_format import format_chats
from .common import read_table, written
from .decontaminate import decontaminate
from .exact_dedup import close_index, deduplicate, open_index
from .fill_in_middle import fill_in_middle, restored
from .fixity import audit, leaves, levels_for, tree, warc_records
from .language_id import identify, train
from .merkle_manifest import field_digest, folded, hex_text, manifest, siblings_digest
from .near_dedup import near_duplicates
from .packing import pack_documents
from .pseudo_likelihood import build_vocabulary, counted, score
from .pseudo_likelihood import train as train_network
from .secrets import KINDS, find_secrets
from .simhash import simhash_duplicates
from .substring_dedup import remove_repeats

#: Buckets of a digest index made for one run; a lasting index sets its own.
INDEX_BUCKETS = 32


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_documents(read_table(spark, sf_dir, "documents"), tokenizer_file())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(spark, read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, read_table(spark, sf_dir, "documents"), words=2)


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(read_table(spark, sf_dir, "conversations"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(spark, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "contaminated", F.col("matches.item_id").alias("item_ids"), F.col("matches.edits").alias("edits"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = open_index(spark, scratch_path(spark, "digest_index"), INDEX_BUCKETS)
    found = deduplicate(spark, read_table(spark, sf_dir, "documents"), index, INDEX_BUCKETS)
    close_index(spark, index)  # the answers lie in written tables
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(spark, read_table(spark, sf_dir, "documents"))

    def listed(spans) -> F.Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def number(kind: str) -> F.Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*KINDS[:3]))
    texts = F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans")
    return found.select("doc_id", *(number(k) for k in KINDS[:3]), *texts, number(KINDS[3]))


#: Size of a segment of op8's archive and the tree over it.
SEGMENT_BYTES, RANGE_BYTES, FANOUT = 64 << 20, 1 << 16, 16


def op8_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixity drill: the pages' archive against a replica with planted faults.

    The replica's records of pages 7, 506, ... (page_id % 499 = 7) have one
    byte changed, those of pages 5, 1002, ... (page_id % 997 = 5) are lost.
    """
    records = written(spark, warc_records(read_table(spark, sf_dir, "pages"), SEGMENT_BYTES), "warc_records")
    changed = F.when(F.col("page_id") % 499 == 7, F.overlay("record", F.lit("#").cast("binary"), F.lit(20), F.lit(1))).otherwise(F.col("record"))
    replica = records.filter("page_id is null or page_id % 997 != 5").withColumn("record", changed)
    levels = levels_for(SEGMENT_BYTES, RANGE_BYTES, FANOUT)
    ours, theirs = (tree(spark, leaves(x), levels, RANGE_BYTES, FANOUT) for x in (records, replica))
    faults = audit(ours, theirs, RANGE_BYTES, FANOUT)
    digests = ours[0].withColumnRenamed("node", "offset")
    roots = ours[-1].select("segment", F.col("digest").alias("segment_root"))
    placed = records.select("page_id", "segment", "offset", "length").join(digests, ["segment", "offset"]).join(faults, ["segment", "offset"], "left").join(roots, "segment")
    return placed.select("page_id", "segment", "offset", "length", F.col("digest").alias("record_sha256"), F.coalesce("fault", F.lit("intact")).alias("status"), "segment_root")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    found = identify(spark, docs, train(spark, docs, ~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected", "cross_entropy")


def op10_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    counts = counted(spark, docs)
    vocabulary = build_vocabulary(spark, docs, common=4095, shared=512, counts=counts)
    return score(spark, docs, vocabulary, train_network(spark, docs, vocabulary), counts=counts)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's proof, checked against the root; n_chars is one too many where 7 divides the id's checksum."""
    docs = read_table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    now = F.when(tampered & F.col("n_chars").isNotNull(), field_digest(docs["doc_id"], docs["source"], docs["lang"], docs["n_chars"] + 1, docs["text"]))
    found = manifest(spark, docs, carried={"now": now}).withColumn("folded_root", folded(F.coalesce("now", "leaf"), F.col("path")))
    hexes = [hex_text(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")]
    return found.select("doc_id", *hexes, siblings_digest(F.col("path")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == hex_text(F.col("root"))).alias("verified"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_duplicates(spark, read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_in_middle(read_table(spark, sf_dir, "documents"))
    texts = F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256")
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *texts)


QUERIES = {
    "op1_pack": op1_pack,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_near_dedup": op3_near_dedup,
    "op4_chat_format": op4_chat_format,
    "op5_decontaminate": op5_decontaminate,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_secrets": op7_secrets,
    "op8_fixity": op8_fixity,
    "op9_language": op9_language,
    "op10_pseudo_likelihood": op10_pseudo_likelihood,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_simhash": op12_simhash,
    "op13_fill_in_middle": op13_fill_in_middle,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: A field as the manifest hashes it.
_FIELD = "coalesce(CAST(strlen({0}) AS VARCHAR) || ':' || {0}, '-')"
#: CRC-32 of an ASCII text: its bytes, then eight shifts each.
_CRC32 = (
    "xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split({0}, ''), lambda s: CAST(ascii(s) AS BIGINT))), "
    "lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))"
)

ORACLE_SQL = {
    "op6_exact_dedup": f"""
WITH d AS (SELECT doc_id, {_LOWER} AS norm FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY norm)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.norm) AS text_sha256
FROM d JOIN g USING (norm)""",
    "op4_chat_format": """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS place,
         count(*) OVER (PARTITION BY conv_id) AS n_turns
  FROM conversations),
rolled AS (
  SELECT conv_id, place, n_turns,
         string_agg(sha256(role || chr(0) || text), ',') OVER (PARTITION BY conv_id ORDER BY place) AS begun
  FROM t),
whole AS (
  SELECT begun, n_turns, min(conv_id) AS conv_id, count(*) AS copies FROM rolled WHERE place = n_turns GROUP BY begun, n_turns),
kept AS (
  SELECT * FROM whole WHERE NOT EXISTS (SELECT 1 FROM rolled r WHERE r.begun = whole.begun AND r.place < r.n_turns)),
line AS (
  SELECT t.conv_id, (t.place - 1) // 128 AS part, t.place, kept.n_turns, kept.copies,
         '<|im_start|>' || role || chr(10) || replace(replace(text, '<|im_start|>', '<| im_start |>'), '<|im_end|>', '<| im_end |>')
           || '<|im_end|>' || chr(10) AS line
  FROM t JOIN kept USING (conv_id))
SELECT conv_id, part, count(*) AS part_turns,
       any_value(n_turns) AS n_turns, any_value(copies) AS copies, string_agg(line, '' ORDER BY place) AS rendered
FROM line GROUP BY conv_id, part""",
    "op11_merkle_manifest": f"""
WITH RECURSIVE d AS (
  SELECT *, {_FIELD.format("CAST(doc_id AS VARCHAR)")} || {_FIELD.format("source")} || {_FIELD.format("lang")} AS head, {_FIELD.format("text")} AS tail FROM documents),
leaf AS (
  SELECT doc_id, lang, sha256(head || {_FIELD.format("CAST(n_chars AS VARCHAR)")} || tail) AS leaf, n_chars IS NULL AS unknown, {_CRC32.format("CAST(doc_id AS VARCHAR)")} AS crc,
         sha256(head || {_FIELD.format("CAST(n_chars + 1 AS VARCHAR)")} || tail) AS other
  FROM d),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY lang) AS total FROM leaf),
node AS (
  SELECT lang, 0 AS level, place, total AS held, leaf AS digest FROM placed
  UNION ALL
  SELECT lang, level + 1, place // 2, (any_value(held) + 1) // 2, sha256(string_agg(digest, '' ORDER BY place))
  FROM node WHERE held > 1 GROUP BY lang, level, place // 2),
sub AS (SELECT lang, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, count(*) OVER () AS total FROM node WHERE held = 1),
top AS (
  SELECT 0 AS level, place, total AS held, subroot AS digest FROM sub
  UNION ALL
  SELECT level + 1, place // 2, (any_value(held) + 1) // 2, sha256(string_agg(digest, '' ORDER BY place)) FROM top WHERE held > 1 GROUP BY level, place // 2),
up AS (
  SELECT doc_id, lang, leaf, place, place AS at, 0 AS level, total AS held, '' AS proof,
         CASE WHEN unknown OR doc_id IS NULL OR crc % 7 <> 0 THEN leaf ELSE other END AS reached
  FROM placed
  UNION ALL
  SELECT up.doc_id, up.lang, up.leaf, up.place, up.at // 2, up.level + 1, (up.held + 1) // 2, proof || coalesce(s.digest, ''),
         sha256(CASE WHEN up.at % 2 = 1 THEN coalesce(s.digest, '') || reached ELSE reached || coalesce(s.digest, '') END)
  FROM up LEFT JOIN node s ON s.lang IS NOT DISTINCT FROM up.lang AND s.level = up.level AND s.place = xor(up.at, 1)
  WHERE up.held > 1),
over AS (
  SELECT up.doc_id, up.lang, up.leaf, up.place, sub.subroot, sub.place AS at, 0 AS level, sub.total AS held, proof, reached
  FROM up JOIN sub ON sub.lang IS NOT DISTINCT FROM up.lang WHERE up.held = 1
  UNION ALL
  SELECT o.doc_id, o.lang, o.leaf, o.place, o.subroot, o.at // 2, o.level + 1, (o.held + 1) // 2, proof || coalesce(s.digest, ''),
         sha256(CASE WHEN o.at % 2 = 1 THEN coalesce(s.digest, '') || reached ELSE reached || coalesce(s.digest, '') END)
  FROM over o LEFT JOIN top s ON s.level = o.level AND s.place = xor(o.at, 1) WHERE o.held > 1)
SELECT doc_id, leaf, subroot, digest AS root, sha256(proof) AS proof_sha256, reached AS folded_root, reached = digest AS verified
FROM over, top WHERE over.held = 1 AND top.held = 1""",
    "op13_fill_in_middle": """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
h AS (
  SELECT doc_id, text, units, len(units) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
         CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
  FROM d),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM h),
p AS (
  SELECT doc_id, n, form, text, coalesce(array_to_string(units[1:low], ''), '') AS pre,
         coalesce(array_to_string(units[low + 1:high], ''), '') AS mid, coalesce(array_to_string(units[high + 1:n], ''), '') AS suf
  FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
              ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(text) AS restored_sha256
FROM p""",
}
