"""Crawling as rounds of DataFrame work around a fetcher plug-in."""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions import web
from docloom.sources.workspace import small_batches

#: Takes (norm_url) and gives (norm_url, html, error), a row for each; mapInPandas over a client, or a join in tests.
Fetcher = Callable[[DataFrame], DataFrame]


def crawl(seeds: DataFrame, fetch: Fetcher, rounds: int, keep: Callable[[DataFrame, int], DataFrame]) -> DataFrame:
    """(norm_url, round, html, error) of the pages reached from seeds (url) within so many rounds.

    A normalized URL is fetched once, in the first round that meets it; links to
    PDF files are not followed. keep(df, n) stores the pages of a round and
    reads them back, so that a round is fetched once whatever comes later.
    """
    frontier = seeds.select(web.normalized(F.col("url")).alias("norm_url")).distinct()
    done = None
    for n in range(rounds):
        if frontier.isEmpty():
            break
        pages = keep(fetch(frontier).withColumn("round", F.lit(n)).select("norm_url", "round", "html", "error"), n)
        done = pages if done is None else done.unionByName(pages)
        links = pages.where("html is not null").select("norm_url", F.explode(web.links(F.col("html"))).alias("link"))
        links = links.withColumn("link", web.cleaned_link(F.col("link"))).where(F.col("link").isNotNull() & ~web.leads_to_pdf(F.col("link")))
        found = links.select(web.normalized(web.resolved(F.col("link"), F.col("norm_url"))).alias("norm_url")).distinct()
        frontier = found.join(done.select("norm_url"), "norm_url", "left_anti")
    return done if done is not None else keep(fetch(frontier).withColumn("round", F.lit(0)).select("norm_url", "round", "html", "error"), 0)


def pdf_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(url, title, pdf_url): the distinct absolute links to PDF files on each page."""
    rows = pages.select(url, web.title(F.col(html)).alias("title"), F.explode(web.links(F.col(html))).alias("link"))
    rows = rows.withColumn("clean", web.cleaned_link(F.col("link"))).where(F.col("clean").isNotNull() & web.leads_to_pdf(F.col("clean")))
    return rows.select(url, "title", web.resolved(F.trim("link"), F.col(url)).alias("pdf_url")).distinct()


def merge_back(documents: DataFrame, crawled: DataFrame) -> DataFrame:
    """documents (public_url, file_path, file_type) with path and type of what was crawled at their URL; URLs that are new are added."""
    new = crawled.groupBy("public_url").agg(F.max_by(F.struct("file_path", "file_type"), F.col("round")).alias("_c"))
    joined = documents.join(new, "public_url", "left")
    kept = joined.select(*[F.coalesce(f"_c.{c}", c).alias(c) if c in ("file_path", "file_type") else F.col(c) for c in documents.columns])
    fresh = new.join(documents, "public_url", "left_anti").select("public_url", F.col("_c.file_path").alias("file_path"), F.col("_c.file_type").alias("file_type"))
    return kept.unionByName(fresh, allowMissingColumns=True)


class Inside:
    """The pieces of a page's text that lie in an element: the page holds each once, an element where they begin and end."""

    def __init__(self, texts: list[str]) -> None:
        self.texts, self.begin, self.end = texts, len(texts), len(texts)

    def __iter__(self) -> Iterator[str]:
        return iter(self.texts[self.begin : self.end])


class Tree(HTMLParser):
    """Elements of a page as a flat list: tag, attributes, parent, last descendant, text inside."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.nodes: list[dict] = []
        self.texts: list[str] = []
        self.open: list[int] = []
        self.counts: Counter[str] = Counter()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.nodes.append({"tag": tag, "attrs": dict(attrs), "parent": self.open[-1] if self.open else -1, "text": Inside(self.texts), "end": len(self.nodes)})
        if tag not in VOID:
            self.open.append(len(self.nodes) - 1)
            self.counts[tag] += 1

    def shut(self) -> str:
        """Closes the innermost open element; its tag."""
        node = self.nodes[self.open.pop()]
        node["end"], node["text"].end = len(self.nodes) - 1, len(self.texts)
        self.counts[node["tag"]] -= 1
        return node["tag"]

    def handle_endtag(self, tag: str) -> None:
        if self.counts[tag]:
            while self.shut() != tag:
                pass

    def handle_data(self, data: str) -> None:
        self.texts.append(data)

    def finish(self) -> Tree:
        self.close()
        while self.open:
            self.shut()
        return self


VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
STEP = re.compile(r"^(?P<tag>[a-zA-Z][\w-]*|\*)?(?:#(?P<id>[\w-]+))?(?P<classes>(?:\.[\w-]+)*)(?:\[(?P<name>[\w-]+)(?:=[\"']?(?P<value>[^\"'\]]*)[\"']?)?\])?$")


def fits(node: dict, step: re.Match) -> bool:
    attrs, has = node["attrs"], set((node["attrs"].get("class") or "").split())
    return (
        (step["tag"] in (None, "*", node["tag"]))
        and (step["id"] is None or attrs.get("id") == step["id"])
        and all(c in has for c in step["classes"].split(".") if c)
        and (step["name"] is None or (step["name"] in attrs and (step["value"] is None or attrs[step["name"]] == step["value"])))
    )


def selected(nodes: list[dict], selector: str, root: int = -1) -> list[int]:
    """Elements inside root that a selector names: tag, #id, .class and [attribute=value], spaces for descendants; several with commas, in page order."""
    low, high = (0, len(nodes) - 1) if root < 0 else (root + 1, nodes[root]["end"])
    out = set()
    for one in selector.split(","):
        steps = [STEP.match(s) for s in one.split()]
        if not steps or any(s is None for s in steps):
            raise ValueError(f"selector {one!r} is not known")
        for i in range(low, high + 1):
            if not fits(nodes[i], steps[-1]):
                continue
            k, up = len(steps) - 2, nodes[i]["parent"]
            while k >= 0 and up >= 0:
                k -= fits(nodes[up], steps[k])
                up = nodes[up]["parent"]
            if k < 0:
                out.add(i)
    return sorted(out)


def extracted(nodes: list[dict], at: int, config: dict) -> dict:
    """What a configuration takes from an element: attributes, its text, and nested elements (one, or all with multiple)."""
    found: dict = {name: nodes[at]["attrs"].get(name) for name in config.get("attributes", [])}
    if config.get("extract") == "text":
        found["text"] = " ".join("".join(nodes[at]["text"]).split())
    for key, inner in (config.get("nested") or {}).items():
        inside = selected(nodes, inner["selector"], at)
        if inner.get("multiple"):
            found[key] = [extracted(nodes, i, inner) for i in inside]
        elif inside:
            found[key] = extracted(nodes, inside[0], inner)
    return found


def rolled_up(data: dict[str, list | None]) -> dict:
    """Counts of the lists and lists of their fields, empty values left out."""
    out: dict = {}
    for key, value in data.items():
        if isinstance(value, list):
            out[f"{key}_count"] = len(value)
            for sub in value[0] if value and isinstance(value[0], dict) else ():
                out[f"{key}_{sub}_list"] = [x[sub] for x in value if x.get(sub)]
    return out


def with_extracts(pages: DataFrame, configs: dict[str, dict], html: str = "html", out: str = "extracted") -> DataFrame:
    """Adds a JSON column: what each configuration (selector, attributes, extract, nested) finds on the page (null: nothing), and the roll-up of it."""

    @F.pandas_udf("string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            found = []
            for text in part.fillna(""):
                tree = Tree()
                tree.feed(text)
                nodes = tree.finish().nodes
                data = {name: [extracted(nodes, i, c) for i in selected(nodes, c["selector"])] or None for name, c in configs.items()}
                found.append(json.dumps({"extracted_data": data, **rolled_up(data)}, ensure_ascii=False))
            yield pd.Series(found, dtype=object)

    small_batches(pages.sparkSession)
    return pages.withColumn(out, run(F.col(html)))
