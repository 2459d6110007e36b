"""A nested evidence corpus: flattening, coverage, and the prompt made from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CORPUS = (
    "summary string, seniority string, constraints array<string>, skills array<struct<group:string,items:array<string>>>, "
    "work_history array<struct<org:string,title:string,period:string,bullets:array<struct<text:string,evidences:array<string>>>>>, "
    "projects array<struct<name:string,text:string,evidences:array<string>>>, education array<string>"
)

#: Headings of the prompt's parts.
HEADINGS = {"summary": "Candidate summary:", "constraints": "Constraints (report as eligibility, rule 2):", "work": "Work done (match against this, not against titles):"}


def evidence_units(corpus: DataFrame, key: str) -> DataFrame:
    """(key, seq, unit_id, source, text, evidences): bullets of all roles in order, then projects."""
    roles = corpus.select(key, F.posexplode("work_history").alias("_r", "role")).select(key, "_r", "role", F.posexplode("role.bullets").alias("_b", "bullet"))
    bullets = roles.select(
        key, F.struct(F.lit(0).alias("part"), "_r", "_b").alias("seq"), F.concat_ws(":", "role.org", "role.period", F.col("_b").cast("string")).alias("unit_id"),
        F.format_string("%s at %s (%s)", "role.title", "role.org", "role.period").alias("source"), F.col("bullet.text").alias("text"), F.col("bullet.evidences").alias("evidences"),
    )
    projects = corpus.select(key, F.posexplode("projects").alias("_p", "project")).select(
        key, F.struct(F.lit(1).alias("part"), F.col("_p").alias("_r"), F.lit(0).alias("_b")).alias("seq"), F.concat(F.lit("project:"), "project.name").alias("unit_id"),
        F.concat(F.lit("project "), "project.name").alias("source"), F.col("project.text").alias("text"), F.col("project.evidences").alias("evidences"),
    )
    return bullets.unionByName(projects)


def coverage(units: DataFrame, families: Sequence[str]) -> DataFrame:
    """(family, n) for every family of the closed set, zeros included."""
    spark = units.sparkSession
    counts = units.select(F.explode("evidences").alias("family")).groupBy("family").agg(F.count("*").alias("n"))
    return spark.createDataFrame([(x,) for x in families], "family string").join(counts, "family", "left").select("family", F.coalesce("n", F.lit(0)).alias("n")).orderBy("family")


def bullets(items: Column) -> Column:
    return F.when(F.size(F.coalesce(items, F.array().cast("array<string>"))) > 0, F.array_join(F.transform(items, lambda x: F.concat(F.lit("- "), x)), "\n")).otherwise("- (none stated)")


def render_prompt(corpus: DataFrame, units: DataFrame, key: str, rubric: str) -> DataFrame:
    """(key, prompt): parts in a fixed order, so equal corpora give equal prompts."""
    lines = units.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("seq", F.concat(F.lit("- ["), "source", F.lit("] "), "text").alias("line")))).alias("_u"))
    df = corpus.join(lines.withColumnRenamed(key, "_key"), corpus[key] == F.col("_key"), "left")
    groups = F.transform("skills", lambda s: F.concat(F.lit("  "), s["group"], F.lit(": "), F.array_join(s["items"], ", ")))
    skills = F.when(F.size(F.coalesce("skills", F.expr("cast(array() as array<struct<group:string,items:array<string>>>)"))) > 0, F.concat(F.lit("Skills:\n"), F.array_join(groups, "\n"), F.lit("\n")))
    education = F.when(F.size(F.coalesce("education", F.array().cast("array<string>"))) > 0, F.concat(F.lit("\nEducation:\n"), bullets(F.col("education"))))
    work = F.concat_ws("\n", F.lit(HEADINGS["work"]), F.transform("_u", lambda u: u["line"]))
    text = F.concat(
        F.concat_ws(
            "\n", F.lit(rubric), F.concat(F.lit("\n" + HEADINGS["summary"] + "\n"), "summary", F.lit("\n")), F.concat(F.lit("Seniority: "), "seniority", F.lit("\n")),
            F.concat(F.lit(HEADINGS["constraints"] + "\n"), bullets(F.col("constraints")), F.lit("\n")), skills, work, education,
        ), F.lit("\n"),
    )
    return df.select(key, text.alias("prompt"))
