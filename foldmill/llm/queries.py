"""One query per operator over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from foldmill.llm import ans, chat, decontaminate, gnat, html, language, mixing, neighbours, pii, quality, separators, simhash, whitening

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.report(table(spark, sf_dir, "pages"))


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ans.token_documents(table(spark, sf_dir, "documents"))


def op4_source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.report(table(spark, sf_dir, "conversations"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat token files of all documents, counted by their separators alone."""
    return separators.document_counts(table(spark, sf_dir, "documents"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gnat.report(table(spark, sf_dir, "embeddings"))


def op12_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.report(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.report(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_main_text": op1_main_text,
    "op2_personal_data": op2_personal_data,
    "op3_token_files": op3_token_files,
    "op4_source_mixture": op4_source_mixture,
    "op5_decontamination": op5_decontamination,
    "op6_quality": op6_quality,
    "op7_simhash_components": op7_simhash_components,
    "op8_nearest_vectors": op8_nearest_vectors,
    "op9_chat_format": op9_chat_format,
    "op10_token_counts": op10_token_counts,
    "op11_vector_codes": op11_vector_codes,
    "op12_language": op12_language,
    "op13_whitening": op13_whitening,
}
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(table_name: str, key: str) -> str:
    return rf"select {key}, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from {table_name}"


_DECONTAMINATION = f"""
with d as ({_words('documents', 'doc_id')}), b as ({_words('benchmark', 'item_id')}),
items as (select item_id, w, least(10, len(w)) n from b where len(w) > 0),
windows as (select distinct item_id, n, array_to_string(w[i : i + n - 1], ' ') t from
    (select item_id, w, n, unnest(range(1, len(w) - n + 2)) i from items)),
places as (select doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') t from
    (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) i from d, (select distinct n from windows) where len(w) >= n)),
hits as (select p.doc_id, p.i, p.n, x.item_id from places p join windows x on x.n = p.n and x.t = p.t),
covered as (select doc_id, count(distinct k) n_hit from (select doc_id, unnest(range(i, i + n)) k from hits) group by doc_id),
named as (select doc_id, count(*) n_items, string_agg(s, ',' order by s) s from
    (select distinct doc_id, cast(item_id as varchar) s from hits) group by doc_id)
select d.doc_id, cast(len(w) as bigint) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items, sha256(coalesce(s, '')) items_sha256,
    coalesce(n_hit, 0) > 0 contaminated from d left join covered using (doc_id) left join named using (doc_id)"""


def _escaped(column: str) -> str:
    return rf"regexp_replace({column}, '<(\\*)\|', '<\1\\|', 'g')"


_CHAT = f"""
with r as (select conv_id, turn, coalesce(role, '') role, coalesce(text, '') text from conversations union all
    select -1, i, ['user', 'assistant'][i + 1], '</s>[INST] ok [/INST]' from range(2) z(i))
select conv_id, count(*) n_turns, sha256(string_agg(concat(role, chr(10), text, chr(10)), '' order by turn, role, text)) turns_sha256,
    cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) loss_sha256,
    cast(sum(length({_escaped('role')}) + length({_escaped('text')}) + {len(chat.TURN + chat.TEXT + chat.END)}) as bigint) formatted_chars
from r group by conv_id"""



def _vector_codes() -> str:
    """Codebooks of 16 parts and 64 entries: two rounds of assignment and rounded means, then a last assignment, all entries compared."""
    away = "list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    sql = f"""
with v as (select vec_id, label, list_transform(embedding, lambda c: cast(floor(256 * cast(c as double)) as bigint)) x from embeddings
    where embedding is not null and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0),
p as materialized (select vec_id, label, pos, x[pos * len(x) // 16 + 1 : (pos + 1) * len(x) // 16] v from v, (select unnest(range(16)) pos)),
b_0 as materialized (select pos, place, v from p join (select vec_id, row_number() over (order by vec_id) - 1 place from v order by vec_id limit 64) using (vec_id))"""
    for step in range(gnat.ROUNDS + 1):
        sql += f""",
a_{step} as materialized (select p.vec_id, p.label, p.pos, p.v, min({away} * 64 + b.place) best from p join b_{step} b using (pos) group by all)"""
        if step < gnat.ROUNDS:
            sql += f""",
m_{step} as (select pos, place, list(mean order by k) v from (
    select pos, best % 64 place, k, (sum(c) - ((sum(c) % count(*)) + count(*)) % count(*)) // count(*) mean from
        (select pos, best, unnest(v) c, unnest(range(len(v))) k from a_{step}) group by all) group by all),
b_{step + 1} as materialized (select b.pos, b.place, coalesce(list_transform(m.v, lambda c: cast(c as bigint)), b.v) v from b_{step} b left join m_{step} m using (pos, place))"""
    last = gnat.ROUNDS
    return sql + f""",
books as (select sha256(string_agg(array_to_string(v, ','), ',' order by pos, place)) codebooks_sha256 from b_{last}),
r as (select vec_id, any_value(label) label, string_agg(lower(printf('%02x', cast(best % 64 as bigint))), '' order by pos) code, cast(sum(best // 64) as bigint) error from a_{last} group by vec_id)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) label_error, codebooks_sha256 from r, books"""


#: The other operators give hashes, token ids, trained scores or sums in another order of addition that the other engine lacks.
ORACLES: dict[str, str] = {"op5_decontamination": _DECONTAMINATION, "op9_chat_format": _CHAT, "op11_vector_codes": _vector_codes()}
