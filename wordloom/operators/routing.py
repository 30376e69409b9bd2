"""Routing of paths and URLs to the agents that handle them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILE, IMAGE, EMAIL, TRANSCRIPT, SHAREPOINT = (
    "File Parsing Agent", "Image Processing Agent", "Email Agent", "Transcript Agent", "SharePoint Agent",
)

# Two rule sets (extension, agent, needs_images); extensions without a row go to the file agent.
_COMMON = (
    ("pdf", FILE, False), ("pdf", IMAGE, True),
    ("pptx", FILE, False), ("pptx", IMAGE, True),
    ("xlsx", FILE, False), ("xlsx", IMAGE, True),
    ("docx", FILE, False), ("ppt", FILE, False),
    ("eml", EMAIL, False), ("msg", EMAIL, False),
    ("vtt", TRANSCRIPT, False), ("txt", TRANSCRIPT, False),
    ("jpg", IMAGE, False), ("png", IMAGE, False), ("gif", IMAGE, False),
)
RULES_WITH_SITE = _COMMON
RULES_WITH_MAIL_IMAGES = _COMMON + (("eml", IMAGE, True), ("msg", IMAGE, True))


def is_url(path: Column) -> Column:
    return F.lower(path).startswith("http")


def extension(path: Column, unclear_url: str = "") -> Column:
    """Lower-case extension without the dot; a URL's comes from its path part."""
    bare = F.when(
        is_url(path), F.regexp_replace(F.regexp_replace(path, "[?#].*$", ""), "^[A-Za-z]+://[^/]*", "")
    ).otherwise(path)
    found = F.lower(F.regexp_extract(bare, r"\.([A-Za-z0-9]+)$", 1))
    return F.when(is_url(path) & (found == ""), F.lit(unclear_url)).otherwise(found)


def route(paths: DataFrame, rules=RULES_WITH_SITE, site_agent: str | None = SHAREPOINT) -> DataFrame:
    """(path, agent), one row per assignment; ``paths(path, has_images)``.

    The rule table becomes one map from extension to agents, so routing is a
    projection and an explode; URLs are taken to hold images.
    """
    plain: dict[str, list[str]] = {}
    pictured: dict[str, list[str]] = {}
    for ext, agent, needs_images in rules:
        (pictured if needs_images else plain).setdefault(ext, []).append(agent)

    def lookup(table: dict[str, list[str]], otherwise: list[str]) -> Column:
        out = F.array(*[F.lit(a) for a in otherwise]).cast("array<string>")
        ext = F.col("_ext")
        for agents in sorted({tuple(v) for v in table.values()}):
            members = [e for e, v in table.items() if tuple(v) == agents]
            out = F.when(ext.isin(*members), F.array(*[F.lit(a) for a in agents])).otherwise(out)
        return out

    none = F.array().cast("array<string>")
    url = is_url(F.col("path"))
    images = F.coalesce("has_images", F.lit(False)) | url
    agents = F.concat(
        lookup(plain, [FILE]),
        F.when(images, lookup(pictured, [])).otherwise(none),
        F.when(url, F.array(F.lit(site_agent))).otherwise(none) if site_agent else none,
    )
    unclear = "pdf" if site_agent else ""
    return paths.withColumn("_ext", extension(F.col("path"), unclear)).select("path", F.explode(agents).alias("agent"))


def mark_processed(assignments: DataFrame) -> DataFrame:
    return assignments.withColumn("status", F.lit("processed"))


def routing_summary(processed: DataFrame) -> DataFrame:
    return processed.groupBy("agent", "status").agg(F.count(F.lit(1)).alias("n"))
