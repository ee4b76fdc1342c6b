"""One query for each operator of this package, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import remainder, table
from .conversation_repair import conversation_repairs, damage
from .decontamination import contaminated
from .jaccard_join import jaccard_classes
from .line_dedup import dedup_lines
from .mixing import mix_sources
from .periodic_runs import run_digests
from .personal_data import personal_data
from .quality_ranking import CUT, fit_quality, score_quality
from .quality_rules import apply_rules, fit_rules
from .repeats import repeat_digests
from .text_stats import COUNTS
from .token_blocks import token_output
from .toxicity import fit_toxicity, score_toxicity
from .url_filter import BLOCKED_DOMAINS, BLOCKED_NAMES, RULES, judge_urls

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def all_sql() -> dict[str, str]:
    return dict(_SQL)


@query
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents"))


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.groupBy("doc_id", "item_id").agg(F.max("matched").alias("matched"), F.max("window").alias("window"))


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    forest = fit_rules(docs, table(spark, sf_dir, "labels"), where=remainder("doc_id", 5) != 0)
    return apply_rules(docs, forest).select("doc_id", *COUNTS, "base_failed", "kept", "score")


@query
def op4_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    ranking = fit_quality(docs, table(spark, sf_dir, "labels"), where=remainder("doc_id", 5) != 0)
    held_out = (remainder("doc_id", 5) == 0).alias("held_out")
    return score_quality(docs, ranking).select("doc_id", held_out, "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


@query
def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(table(spark, sf_dir, "documents"), width=4, percent=85)


@query
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))


@query
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"), where=remainder("doc_id", 4) != 2)
    held_out = (remainder("doc_id", 4) == 2).alias("held_out")
    return score_toxicity(docs, model).select("doc_id", held_out, "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


@query
def op10_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output(table(spark, sf_dir, "documents"))


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(table(spark, sf_dir, "documents"))


@query
def op12_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_digests(table(spark, sf_dir, "documents"))


@query
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return conversation_repairs(damage(turns), turns)


def _rule_rows() -> str:
    return ", ".join(f"('{host}', '{path}', '{says}')" for host, path, says in RULES)


def _blocked_rows() -> str:
    return ", ".join(f"('{name}.{domain}')" for name in BLOCKED_NAMES for domain in BLOCKED_DOMAINS)


_SQL["op6_url_filter"] = f"""
with rules(rule_host, rule_path, says) as (values {_rule_rows()}),
blocked(entry) as (values {_blocked_rows()}),
rests as (
  select page_id, url, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest
  from pages
),
parts as (
  select page_id, url,
    translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from rests
),
ruled as (
  select page_id, host, path,
    (select arg_max(rule_host || rule_path, length(rule_host || rule_path)) from rules
     where (host = rule_host or host like '%.' || rule_host) and starts_with(path, rule_path)) as rule,
    (select arg_max(says, length(rule_host || rule_path)) from rules
     where (host = rule_host or host like '%.' || rule_host) and starts_with(path, rule_path)) as says,
    exists (select 1 from blocked where host = entry or host like '%.' || entry) as listed
  from parts
)
select page_id, host, path, rule, coalesce(says, case when listed then 'block' else 'allow' end) as verdict
from ruled
"""
