"""The registered queries of the operators: production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import chat, fingerprint, licenses, media, neardup, packing, pieces, privacy, quality, repair, rules, secrets, wavelet
from .base import table


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets_digest(table(spark, sf_dir, "documents"))


def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(table(spark, sf_dir, "documents"))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chats_digest(chat.control_conversation(table(spark, sf_dir, "conversations")))


def op4_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licenses_digest(table(spark, sf_dir, "documents"))


def op5_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_digest(table(spark, sf_dir, "documents"))


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(table(spark, sf_dir, "documents"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.pieces_digest(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return privacy.private_digest(table(spark, sf_dir, "documents"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.rules_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.middles_digest(table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repairs_digest(table(spark, sf_dir, "conversations"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_secret_scans,
        op2_document_fingerprints,
        op3_chat_formatting,
        op4_license_scans,
        op5_media_columns,
        op6_minhash_near_dedup,
        op7_sentencepiece,
        op8_quality_classifier,
        op9_pii,
        op10_best_fit_packing,
        op11_quality_rules,
        op12_fill_in_middle,
        op13_conversation_repair,
    )
}

_SAID = r"'\### Assistant: </turn> ok'"
#: What the escapes add: three characters for each control character.
_CODED = "length({0}) + 3 * (length({0}) - length(replace(replace(replace({0}, '\\', ''), '<', ''), '>', '')))"



def _repair_sql() -> str:
    """op13 as a recursion over turns from the last to the first: each grammar state's cost (9 digits) and audit as one text, so that the least text is the cheapest and least audit."""
    add = lambda v, c, letter: f"concat(lpad(CAST(CAST({v}[1:9] AS BIGINT) + {c} AS VARCHAR), 9, '0'), '{letter}', {v}[10:])"
    never = "'900000000'"
    extra = "CASE WHEN fault = 't' THEN 5 ELSE 0 END"

    def turn(state: str, legal: str, after: str) -> str:
        keep = f"WHEN initial = '{legal}' THEN {add(after, extra, 'K')}" + (f" WHEN initial = 's' THEN {add('s', extra, 'K')}" if state == "n" else "")
        return f"least({add(state, 2, 'D')}, CASE WHEN fault IN ('b', 'd') THEN {never} ELSE {add(after, f'1 + {extra}', 'R')} END, CASE WHEN fault IN ('b', 'd') THEN {never} {keep} ELSE {never} END)"

    ended = lambda n, s, u, a: f"least({n}, {add(f'least({u}, {add(a, 5, "I")})', 5, 'I')}) AS n, least({s}, {add(f'least({u}, {add(a, 5, "I")})', 5, 'I')}) AS s, least({u}, {add(a, 5, 'I')}) AS u, least({a}, {add(u, 5, 'I')}) AS a"
    steps = ", ".join(f"{turn(q, legal, after)} AS {q}" for q, legal, after in (("n", "u", "u"), ("s", "u", "u"), ("u", "a", "a"), ("a", "u", "u")))
    bits = "xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)"
    return f"""WITH RECURSIVE codes AS (SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(CAST(b AS BIGINT), range(8)), lambda c, i: {bits})) AS t),
keyed AS (SELECT *, concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' ')) AS k FROM conversations),
damage AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
 xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(k, ''), lambda x: CAST(ascii(x) AS BIGINT))), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind FROM keyed, codes),
rows_ AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM damage),
same AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) > 1 AS again FROM rows_),
judged AS (SELECT *, row_number() OVER w AS place, lag(role[1:1]) OVER w AS before FROM same WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), again)),
turns AS (SELECT conv_id, place, turn, role, text, role[1:1] AS initial, before, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'b' WHEN again THEN 'd' WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 't' ELSE '' END AS fault FROM judged),
sums AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
 count(*) FILTER (concat(before, initial) NOT IN ('su', 'ua', 'au') AND before IS NOT NULL) AS illegal FROM turns GROUP BY 1),
walk AS (SELECT conv_id, n AS place, {ended("'000000000'", never, never, "'000000000'")} FROM (SELECT conv_id, n FROM sums)
 UNION ALL SELECT conv_id, place, {ended("n", "s", "u", "a")} FROM (SELECT w.conv_id, w.place - 1 AS place, {steps} FROM walk w JOIN turns t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.place = w.place)),
best AS (SELECT conv_id, CAST(n[1:9] AS BIGINT) AS cost, n[10:] AS audit FROM walk WHERE place = 0),
letters AS (SELECT conv_id, unnest(range(1, length(audit) + 1)) AS step, audit FROM best),
spelled AS (SELECT conv_id, step, audit[step:step] AS edit, length(replace(audit[1:step], 'I', '')) AS place, length(replace(audit[1:step], 'D', '')) AS kept FROM letters),
used AS (SELECT l.*, CASE WHEN edit <> 'I' THEN t.text ELSE '' END AS text, CASE WHEN edit = 'K' THEN t.role END AS own FROM spelled l LEFT JOIN turns t ON t.conv_id IS NOT DISTINCT FROM l.conv_id AND t.place = l.place AND edit <> 'I' WHERE edit <> 'D'),
said AS (SELECT *, max(CASE WHEN own[1:1] = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS led FROM used),
repaired AS (SELECT conv_id, string_agg(concat(coalesce(own, CASE WHEN (kept - led) % 2 = 1 THEN 'user' ELSE 'assistant' END), ':', text), chr(10) ORDER BY step) AS whole FROM said GROUP BY 1)
SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i LEFT JOIN sums s ON s.conv_id IS NOT DISTINCT FROM i.conv_id LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM i.conv_id LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM i.conv_id"""


#: DuckDB SQL where SQL can express the whole result; the others are held against brute force in tests/llm.
ORACLES: dict[str, str] = {
    "op3_chat_formatting": f"""WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS alone FROM conversations
  UNION ALL SELECT -7, 0, 'user', {_SAID}, NULL UNION ALL SELECT -7, 1, 'assistant', {_SAID}, NULL),
o AS (SELECT *, row_number() OVER w AS place, lag(role) OVER w AS last, {_CODED.format("text")} AS text_size, {_CODED.format("role")} AS role_size FROM turns WINDOW w AS (PARTITION BY conv_id, alone ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY place)) AS turns_sha256, CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
 sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256, CAST(sum(text_size + CASE WHEN last IS NULL THEN role_size + {len("<||>")} WHEN last = role THEN {len(chat.TURN)} ELSE {len(chat.END)} + role_size + {len("<||>")} END) + {len(chat.END)} AS BIGINT) AS formatted_chars FROM o GROUP BY conv_id, alone""",
    "op12_fill_in_middle": """WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256(concat('1:', CAST(doc_id AS VARCHAR))) AS h FROM documents),
u AS (SELECT *, length(t) AS n, CAST(concat('0x', substr(h, 1, 8)) AS BIGINT) AS h1, CAST(concat('0x', substr(h, 9, 8)) AS BIGINT) AS h2, CAST(concat('0x', substr(h, 17, 8)) AS BIGINT) AS h3, CAST(concat('0x', substr(h, 25, 8)) AS BIGINT) AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS p, greatest(h1 % (n + 1), h2 % (n + 1)) AS m, CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
x AS (SELECT *, t[1:p] AS pre, t[p + 1:m] AS mid, t[m + 1:] AS post FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN p END AS prefix_chars, CASE WHEN form <> 'plain' THEN m - p END AS middle_chars,
 sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN concat('<P>', pre, '<S>', post, '<M>', mid) ELSE concat('<S>', post, '<P>', pre, '<M>', mid) END) AS output_sha256, sha256(concat(pre, mid, post)) AS restored_sha256 FROM x""",
    "op13_conversation_repair": _repair_sql(),
}
