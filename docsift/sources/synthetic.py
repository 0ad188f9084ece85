"""Seeded synthetic labelled documents from a category catalogue.

A catalogue is a DataFrame ``(name, description, skills array<string>)``. The
same seed gives the same rows on every run and any partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEVELS = ["Junior", "Deputy", "Chief", "Visiting"]
EMPLOYERS = ["Northfield Systems", "Harbour Analytics", "Brightline Works", "Cedar Group"]
SCHOOLS = ["Lakeside University", "Institute of Applied Science", "Polytechnic College"]
VERBS = ["designed and ran", "maintained", "led the delivery of", "improved"]


def _draw(seed: int, purpose: str) -> Column:
    return F.xxhash64(F.lit(seed), F.col("name"), F.col("copy"), F.lit(purpose))


def _between(seed: int, purpose: str, low: int, high: int) -> Column:
    return (F.pmod(_draw(seed, purpose), F.lit(high - low + 1)) + low).cast("int")


def _pick(seed: int, purpose: str, options: list[str]) -> Column:
    place = F.pmod(_draw(seed, purpose), F.lit(len(options))).cast("int")
    return F.get(F.array(*[F.lit(o) for o in options]), place)


def _shuffled_skills(seed: int, purpose: str) -> Column:
    keyed = F.transform(
        F.col("skills"),
        lambda s: F.struct(
            F.xxhash64(F.lit(seed), F.col("name"), F.col("copy"), F.lit(purpose), s).alias("key"),
            s.alias("skill"),
        ),
    )
    return F.transform(F.sort_array(keyed), lambda e: e["skill"])


def _copies(catalogue: DataFrame, n_per_category: int) -> DataFrame:
    return catalogue.select(
        "name",
        "description",
        "skills",
        F.explode(F.sequence(F.lit(1), F.lit(n_per_category))).alias("copy"),
    )


def synthetic_corpus(catalogue: DataFrame, n_per_category: int = 50, seed: int = 42) -> DataFrame:
    """Long-form documents ``(category, text)``, ``n_per_category`` per category."""
    main = F.slice(F.col("main"), 1, _between(seed, "n_main", 7, 12))
    extra = F.slice(_shuffled_skills(seed, "extra"), 1, _between(seed, "n_extra", 3, 5))
    rows = _copies(catalogue, n_per_category).withColumn("main", _shuffled_skills(seed, "main"))
    title = F.concat_ws(" ", _pick(seed, "level", LEVELS), F.col("name"), F.lit("Professional"))
    first = F.coalesce(F.get("main", F.lit(0)), F.lit(""))
    lines = [
        F.lit("SUMMARY:"),
        F.concat(
            title, F.lit(" with "), _between(seed, "years", 2, 12).cast("string"),
            F.lit(" years of experience in "), F.lower("description"),
        ),
        F.lit("SKILLS:"),
        F.array_join(main, ", "),
        F.array_join(extra, ", "),
        F.lit("EXPERIENCE:"),
        F.concat(
            title, F.lit(" | "), _pick(seed, "employer", EMPLOYERS), F.lit(" (2020 - Present): "),
            _pick(seed, "verb", VERBS), F.lit(" systems based on "), first,
        ),
        F.lit("EDUCATION:"),
        _pick(seed, "school", SCHOOLS),
    ]
    return rows.select(F.col("name").alias("category"), F.concat_ws("\n", *lines).alias("text"))


def short_corpus(catalogue: DataFrame, n_per_category: int = 100, seed: int = 42) -> DataFrame:
    """One-line documents with up to six skills."""
    rows = _copies(catalogue, n_per_category).withColumn(
        "picked", F.slice(_shuffled_skills(seed, "short"), 1, 6)
    )
    text = F.concat(
        F.lit("Summary: "), F.col("name"), F.lit(" professional. Skills: "),
        F.array_join("picked", ", "), F.lit(". Experience: worked with "),
        F.coalesce(F.get("picked", F.lit(0)), F.lit("")), F.lit("."),
    )
    return rows.select(F.col("name").alias("category"), text.alias("text"))


def add_missing_categories(
    corpus: DataFrame, catalogue: DataFrame, n_per_category: int = 100, seed: int = 42
) -> DataFrame:
    """Append synthetic rows for catalogue categories the corpus lacks."""
    present = corpus.select(F.col("category").alias("name")).distinct()
    missing = catalogue.join(present, "name", "left_anti")
    return corpus.select("category", "text").unionByName(
        short_corpus(missing, n_per_category, seed)
    )
