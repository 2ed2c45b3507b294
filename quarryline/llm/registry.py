"""Queries of the training-data operators, by name, and SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarryline.llm import entries, language, lookalikes, mixing, mojibake, names, packing, quality, residue, topn
from quarryline.session import cut
from quarryline.sources.tables import read_table


def _language_model(spark: SparkSession, folder: str) -> language.Classifier:
    return language.fit(language.labelled_sample(read_table(spark, folder, "documents")))


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    metadata = read_table(spark, folder, "domain_metadata")
    cases = cut(language.suspects(metadata, _language_model(spark, folder)))
    # only the cases are looked through for residue and damage; what damage looks like is learned from all texts
    described = cut(residue.field_texts(metadata, fields=("description",)).join(cases.select("domain"), "domain", "left_semi"))
    residual = residue.with_residue(described, "text").filter("residue is not null").select("domain")
    damaged = mojibake.restore(residue.field_texts(metadata), described).select("domain")
    return language.misdeclared(cases, residual.unionByName(damaged))


def p1_languages(spark: SparkSession, folder: str) -> DataFrame:
    rows = read_table(spark, folder, "domain_metadata").select("domain", "language", "description").distinct()
    return language.with_language(language.with_segments(rows, "description", _language_model(spark, folder)))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return residue.residue_fields(read_table(spark, folder, "domain_metadata")).select("domain", "field").distinct()


def p2_marked(spark: SparkSession, folder: str) -> DataFrame:
    return residue.with_residue(residue.field_texts(read_table(spark, folder, "domain_metadata")), "text")


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    contacts = lookalikes.lookalike_rows(read_table(spark, folder, "domain_contacts"), "id", "value", "domain_contacts.value")
    people = lookalikes.lookalike_rows(read_table(spark, folder, "domain_employees"), "id", "name", "domain_employees.name")
    return contacts.unionByName(people).distinct()


def p3_canonical(spark: SparkSession, folder: str) -> DataFrame:
    contacts = read_table(spark, folder, "domain_contacts").select("id", "domain", "entity_type", "value")
    return lookalikes.with_canonical(contacts, "value")


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return topn.best_contacts(read_table(spark, folder, "domain_contacts"), 3).select("id")


def p5_restored(spark: SparkSession, folder: str) -> DataFrame:
    return mojibake.restore(residue.field_texts(read_table(spark, folder, "domain_metadata")))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return p5_restored(spark, folder).select("domain", "field").distinct()


def p6_mapped(spark: SparkSession, folder: str) -> DataFrame:
    places = read_table(spark, folder, "ref_places").select(F.col("place_id").alias("ref_id"), F.col("place").alias("name"), "area", "code")
    titles = read_table(spark, folder, "ref_titles").select(F.col("title_id").alias("ref_id"), F.col("title").alias("name"))
    located = read_table(spark, folder, "domain_metadata").select(F.col("domain").alias("record_key"), F.col("location").alias("value"))
    people = read_table(spark, folder, "domain_employees").select(F.col("id").cast("string").alias("record_key"), F.col("title").alias("value"))
    a = entries.mapped(located, places, "place", areas=True).withColumn("field", F.lit("location"))
    b = entries.mapped(people, titles, "title", extra=places).withColumn("field", F.lit("title"))
    return a.unionByName(b).select("field", "record_key", "value", "ref_id", "score")


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return p6_mapped(spark, folder).select("field", "record_key", "ref_id").distinct()


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return names.linked_pairs(read_table(spark, folder, "domain_employees"))


def p7_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return names.clusters(read_table(spark, folder, "domain_employees"))


def p8_packed(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(read_table(spark, folder, "documents"), read_table(spark, folder, "container_specs"))


def p8_fills(spark: SparkSession, folder: str) -> DataFrame:
    return packing.fills(p8_packed(spark, folder))


def p9_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed(read_table(spark, folder, "documents"), read_table(spark, folder, "mix_targets"))[0]


def p9_shares(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed(read_table(spark, folder, "documents"), read_table(spark, folder, "mix_targets"))[1]


def p10_scored(spark: SparkSession, folder: str) -> DataFrame:
    return quality.scored(read_table(spark, folder, "documents"))


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    return p10_scored(spark, folder).filter("not is_prose").select("doc_id")


QUERIES = {
    "p8_packed": p8_packed,
    "p8_fills": p8_fills,
    "p9_mix": p9_mix,
    "p9_shares": p9_shares,
    "p10_found": p10_found,
    "p10_scored": p10_scored,
    "p7_found": p7_found,
    "p7_clusters": p7_clusters,
    "p6_found": p6_found,
    "p6_mapped": p6_mapped,
    "p1_found": p1_found,
    "p1_languages": p1_languages,
    "p2_found": p2_found,
    "p2_marked": p2_marked,
    "p5_found": p5_found,
    "p5_restored": p5_restored,
    "p3_found": p3_found,
    "p3_canonical": p3_canonical,
    "p4_found": p4_found,
}

ORACLE = {
    "p4_found": """
        SELECT id FROM (
            SELECT id, row_number() OVER (PARTITION BY domain, entity_type
                ORDER BY score DESC NULLS LAST, fetched_at DESC NULLS LAST, id) AS rn
            FROM domain_contacts)
        WHERE rn <= 3""",
}
