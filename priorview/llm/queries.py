"""Queries of the llm problems (p5 to p9)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from priorview.functions.keys import current_rows, norm_id
from priorview.llm.leakage import leak_spans, leaked_items
from priorview.llm.names import SHORT_FORMS, Linking, Physique, cluster_pairs, link_profiles, link_spellings
from priorview.llm.ranking import comparisons, rank_items
from priorview.llm.splitting import split_corpus
from priorview.llm.tokenizer import Vocabulary, decode_corpus, encode_corpus
from priorview.session import table

#: Where the public vocabularies lie; a parameter, they are no part of this repository.
TOKENIZERS = os.environ.get("PRIORVIEW_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k.json"


def _vocabulary(spark: SparkSession) -> Vocabulary:
    return Vocabulary(spark, f"{TOKENIZERS}/{VOCABULARY}")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def official_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = table(spark, sf_dir, "fights").select(F.explode(F.array("referee", "judge_1", "judge_2", "judge_3")).alias("name")).filter("name <> ''")
    return link_spellings(typed, "name", Linking(short_forms=SHORT_FORMS))


def fighter_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a fighter_id: the newest name, and the newest believable value of each measure and of the day of birth."""
    rows = table(spark, sf_dir, "fighters").withColumn("fighter_id", norm_id("fighter_id")).filter("fighter_id is not null")
    believable = {"dob": F.col("dob").between(F.lit("1940-01-01").cast("date"), F.lit("2006-12-31").cast("date")), "height_cm": F.col("height_cm").between(120, 230), "reach_cm": F.col("reach_cm").between(120, 230), "weight_lbs": F.col("weight_lbs").between(80, 600)}
    newest = [F.max_by(c, F.when(ok, F.struct("scraped_at", c))).alias(c) for c, ok in believable.items()]
    return rows.groupBy("fighter_id").agg(F.max_by("full_name", F.when(F.col("full_name").isNotNull(), F.struct("scraped_at", "full_name"))).alias("full_name"), *newest)


def linked_fighters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_profiles(fighter_profiles(spark, sf_dir), "fighter_id", "full_name", "dob", Physique({"height_cm": 2.6, "reach_cm": 2.1, "weight_lbs": 2.0}), SHORT_FORMS)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    officials = cluster_pairs(official_spellings(spark, sf_dir), "name", "cluster").select(F.lit("official").alias("entity_type"), "key_a", "key_b")
    fighters = cluster_pairs(linked_fighters(spark, sf_dir), "key", "cluster").select(F.lit("fighter").alias("entity_type"), "key_a", "key_b")
    return officials.unionByName(fighters)


def p5_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every spelling of an official and every fighter profile with its cluster."""
    return official_spellings(spark, sf_dir).select(F.lit("official").alias("entity_type"), F.col("name").alias("key"), "cluster").unionByName(linked_fighters(spark, sf_dir).select(F.lit("fighter").alias("entity_type"), "key", "cluster"))


def p6_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All fighters with strength, wins and losses."""
    bouts = current_rows(table(spark, sf_dir, "fights"), "fight_id", ["fight_id", "fighter_1_id", "fighter_2_id", "winner_fighter_id", "result_type"]).filter("result_type = 'win'")
    sides = bouts.select(*[norm_id(c).alias(c) for c in ("winner_fighter_id", "fighter_1_id", "fighter_2_id")])
    fighters = table(spark, sf_dir, "fighters").select(norm_id("fighter_id").alias("item"))
    return rank_items(comparisons(sides, "winner_fighter_id", "fighter_1_id", "fighter_2_id"), fighters).withColumnRenamed("item", "fighter_id")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = table(spark, sf_dir, "ranking_panel").select("panel_id", norm_id("fighter_id").alias("fighter_id")).distinct()
    ranked = panel.join(p6_ranking(spark, sf_dir).select("fighter_id", "strength"), "fighter_id", "left").withColumn("strength", F.coalesce("strength", F.lit(1.0)))
    a, b = ranked.toDF("fighter_a", "panel_id", "sa"), ranked.toDF("fighter_b", "panel_id", "sb")
    return a.join(b, "panel_id").filter("fighter_a < fighter_b and sa > sb").select("panel_id", "fighter_a", "fighter_b")


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_corpus(_documents(spark, sf_dir), _vocabulary(spark), "doc_id", "text")


def p7_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts again, from their ids; '' for an empty or null one."""
    return decode_corpus(p7_ids(spark, sf_dir), _vocabulary(spark), "doc_id")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaked_items(_documents(spark, sf_dir), table(spark, sf_dir, "eval_items"), "doc_id", "text", "item_id")


def p8_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the leaks lie in the original texts."""
    return leak_spans(_documents(spark, sf_dir), table(spark, sf_dir, "eval_items"), "doc_id", "text", "item_id")


def p9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in pieces of at most 1,024 tokens; those that fit in one."""
    return split_corpus(_documents(spark, sf_dir), _vocabulary(spark), "doc_id", "text")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p9_pieces(spark, sf_dir).filter("piece = 1").select("doc_id")


QUERIES = {f.__name__: f for f in (p5_found, p5_clusters, p6_found, p6_ranking, p7_ids, p7_decoded, p8_found, p8_spans, p9_found, p9_pieces)}

SQL = {"p7_decoded": "SELECT doc_id, coalesce(text, '') AS text FROM documents"}
