"""URLs and HTML."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Schemes of links that lead nowhere, and the ending and marks of links to PDF files.
DEAD_SCHEMES = ("javascript:", "mailto:", "tel:", "data:")
PDF_ENDING = ".pdf"
PDF_MARKS = ("application/pdf", "/pdf/", "download=pdf", "type=pdf", "format=pdf")


def normalized(url: Column) -> Column:
    """Scheme, host and path only: no parameters, query or fragment."""
    return F.regexp_replace(url, "[;?#].*", "")


def is_pdf(url: Column) -> Column:
    return F.contains(F.lower(url), F.lit("/pdf")) | F.endswith(F.lower(url), F.lit(".pdf"))


def title(html: Column) -> Column:
    return F.nullif(F.trim(F.regexp_extract(html, "(?is)<title>(.*?)</title>", 1)), F.lit(""))


def links(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit('<a[^>]*href="([^"]*)"'), F.lit(1))


def cleaned_link(link: Column) -> Column:
    """Trimmed, lower case, without fragment; null if empty or of a dead scheme."""
    plain = F.regexp_replace(F.lower(F.trim(link)), "#.*", "")
    dead = F.lit(False)
    for scheme in DEAD_SCHEMES:
        dead = dead | F.startswith(plain, F.lit(scheme))
    return F.when((plain != "") & ~dead, plain)


def leads_to_pdf(link: Column) -> Column:
    """Whether a cleaned link ends in .pdf or has one of the marks."""
    found = F.endswith(link, F.lit(PDF_ENDING))
    for mark in PDF_MARKS:
        found = found | F.contains(link, F.lit(mark))
    return found


def resolved(link: Column, base: Column) -> Column:
    """An absolute URL: as it is, from the base's root, or beside the base's last path part."""
    host = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+)", 1)
    folder = F.when(F.rlike(normalized(base), F.lit(r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]+$")), F.concat(normalized(base), F.lit("/"))).otherwise(F.regexp_replace(normalized(base), "[^/]*$", ""))
    return (
        F.when(F.rlike(link, F.lit(r"^[a-zA-Z][a-zA-Z0-9+.-]*:")), link)
        .when(F.startswith(link, F.lit("//")), F.concat(F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1), link))
        .when(F.startswith(link, F.lit("/")), F.concat(host, link))
        .otherwise(F.concat(folder, link))
    )
