"""Column functions on URLs, pages and sitemaps."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Hosting platforms and how their URLs name a board, the first that matches counts.
PLATFORMS = [
    ("Greenhouse", r"greenhouse\.io/(?:v1/boards/|embed/job_board(?:/js)?\?for=)?([\w.-]+)"),
    ("Lever", r"(?:jobs|api)(?:\.eu)?\.lever\.co/(?:v0/postings/)?([\w.-]+)"),
    ("Ashby", r"ashbyhq\.com/(?:posting-api/job-board/)?([\w.-]+(?: [\w.-]+)*)"),
    ("SmartRecruiters", r"smartrecruiters\.com/(?:v1/companies/)?([\w.-]+)"),
    ("Workday", r"([\w-]+)\.(?:wd\d+\.)?myworkdayjobs\.com"),
    ("BambooHR", r"([\w-]+)\.bamboohr\.com"),
    ("Workable", r"apply\.workable\.com/([\w.-]+)"),
    ("Recruitee", r"([\w-]+)\.recruitee\.com"),
    ("Teamtailor", r"([\w-]+)\.teamtailor\.com"),
    ("BreezyHR", r"([\w-]+)\.breezy\.hr"),
    ("JazzHR", r"([\w-]+)\.applytojob\.com"),
    ("Pinpoint", r"([\w-]+)\.pinpointhq\.com"),
    ("iCIMS", r"([\w-]+)\.icims\.com"),
    ("Dayforce", r"([\w-]+)\.dayforcehcm\.com"),
    ("ADP", r"(workforcenow|recruiting|myjobs)\.adp\.com"),
    ("SuccessFactors", r"(?:[\w-]+\.)?(?:successfactors\.(?:com|eu)|sapsf\.com)|jobs\.sap\.com"),
    ("UKG", r"([\w-]+)\.(?:ukg|ultipro|ukgpro)\.(?:com|ca)"),
    ("Oracle HCM", r"\.oraclecloud\.com|([\w-]+)\.taleo\.net"),
    ("Paylocity", r"recruiting\.paylocity\.com"),
    ("Rippling", r"ats\.rippling\.com"),
    ("Jobvite", r"jobvite\.com"),
    ("Phenom", r"([\w-]+)\.phenompeople\.com|phenom\.com"),
    ("Eightfold", r"([\w-]+)\.eightfold\.ai"),
    ("Njoyn", r"([\w-]+\.)?njoyn\.com"),
    ("Humi", r"([\w-]+)\.humi\.ca"),
    ("Indeed", r"(?:[\w-]+\.)?indeed\.com"),
]
#: Path words that are no board name.
NOT_BOARDS = (
    "v1 v0 api embed jobs job boards board www posting-api job-board postings companies for js users user auth login signup account accounts "
    "career careers widget job-widget list offers detail"
).split()
#: Board names; one source allows single inner spaces.
PLAIN_REF = r"^[A-Za-z0-9][A-Za-z0-9._-]*\z"
SPACED_REF = r"^[A-Za-z0-9][A-Za-z0-9._-]*(?: [A-Za-z0-9._-]+)*\z"
#: Words of job titles, mail hints, and marks of pages that a browser renders.
JOB_WORDS = r"(?i)\b(engineer|analyst|manager|developer|specialist|coordinator|technician|director|administrator|designer|accountant|supervisor|consultant)\b"
MAIL_HINTS = r"(?i)mailto:|resume|resumé|cv\b|send (us )?your"
APP_MARKS = r"(?i)__NEXT_DATA__|__NUXT__|window\.__|id=[\"'](root|app|__next)[\"']|ng-version|data-reactroot|wp-json|/_next/|vue\.js|react-dom"
#: Career pages in sitemaps.
CAREER = r"(?i)career|jobs?|join|hiring|opportunit"
CAREER_END = r"careers?/?$|jobs?/?$"


def unquote(url: Column) -> Column:
    """Percent-decoded; plus signs stay, and a text with bad escapes stays as it is."""
    return F.coalesce(F.try_url_decode(F.replace(url, F.lit("+"), F.lit("%2B"))), url)


def platform_of(url: Column, patterns: list[tuple[str, str]] = PLATFORMS) -> Column:
    """struct(platform, token) of the first pattern in order that matches; the token is its group, '' without one."""
    u = F.lower(unquote(F.coalesce(url, F.lit(""))))
    token = lambda p: F.trim(F.coalesce(F.regexp_extract(u, p, 1), F.lit(""))) if re.compile(p).groups else F.lit("")
    return F.coalesce(*[F.when(u.rlike(p), F.struct(F.lit(n).alias("platform"), token(p).alias("token"))) for n, p in patterns])


def ref_ok(source: Column, token: Column) -> Column:
    form = F.when(source == "ashby", token.rlike(SPACED_REF)).otherwise(token.rlike(PLAIN_REF))
    return F.coalesce(form & ~F.lower(token).isin(NOT_BOARDS), F.lit(False))


def normalize_domain(raw: Column) -> Column:
    """Lower case, without scheme and path; null gives ''."""
    d = F.lower(F.trim(F.coalesce(raw, F.lit(""))))
    return F.regexp_replace(F.regexp_replace(d, r"^.*?://", ""), r"(?s)/.*$", "")


def probe_tokens(name: Column, website: Column) -> Column:
    """Up to four candidate board names from a company's name and host, distinct, in order."""
    host = F.regexp_replace(normalize_domain(website), r"^www\.", "")
    clean = F.trim(F.regexp_replace(F.lower(F.coalesce(name, F.lit(""))), r"[^a-z0-9 ]", ""))
    forms = F.array(F.replace(clean, F.lit(" "), F.lit("")), F.replace(clean, F.lit(" "), F.lit("-")), F.split_part(host, F.lit("."), F.lit(1)), host)
    return F.slice(F.filter(F.array_distinct(forms), lambda t: ref_ok(F.lit("greenhouse"), t)), 1, 4)


@F.pandas_udf(T.ArrayType(T.StringType()))
def sitemap_locations(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """All locations of a sitemap; [] for null or bad XML, where the built-in xpath would fail the job."""

    def locations(text: str | None) -> list[str]:
        try:
            return [e.text for e in ET.fromstring(text or "").iter() if e.tag.endswith("loc") and e.text]
        except ET.ParseError:
            return []

    for s in batches:
        yield s.map(locations)


def career_locations(locations: Column) -> Column:
    """Career pages, those that end like one first, distinct."""
    career = F.filter(locations, lambda u: u.rlike(CAREER))
    ends = lambda u: F.lower(u).rlike(CAREER_END)
    return F.array_distinct(F.concat(F.filter(career, ends), F.filter(career, lambda u: ~ends(u))))


def nested_sitemaps(locations: Column) -> Column:
    return F.filter(locations, lambda u: F.lower(u).endswith(".xml"))


def page_shape(html: Column) -> Column:
    """jsonld, linky (three or more links that read like job titles), prose (job words and a mail hint) or empty."""
    blocks = F.regexp_extract_all(html, F.lit(r"(?is)<script[^>]+type=[\"']application/ld\+json[\"'][^>]*>(.*?)</script>"), F.lit(1))
    titles = F.transform(
        F.regexp_extract_all(html, F.lit(r"(?is)<a\b[^>]*>(.*?)</a>"), F.lit(1)), lambda a: F.regexp_replace(F.regexp_replace(a, r"<[^>]+>", ""), r"^\s+|\s+$", "")
    )
    jobs = F.filter(titles, lambda t: (F.length(t) > 6) & (F.length(t) < 90) & t.rlike(JOB_WORDS))
    text = F.regexp_replace(html, r"<[^>]+>", " ")
    mail = text.rlike(MAIL_HINTS) | F.lower(html).contains("mailto:")
    return (
        F.when(F.exists(blocks, lambda b: F.lower(b).contains("jobposting")), "jsonld")
        .when(F.size(jobs) >= 3, "linky").when(text.rlike(JOB_WORDS) & mail, "prose").otherwise("empty")
    )


def page_text(html: Column) -> Column:
    """Visible text with white space squeezed."""
    return F.btrim(F.regexp_replace(F.regexp_replace(html, r"(?s)<(script|style).*?</\1>|<[^>]+>", " "), r"\s+", " "))


def rendering(html: Column) -> Column:
    """struct(n_text, scripts, verdict): SPA with an app mark and under 2500 characters, thin under 800, else plain."""
    n = F.length(page_text(html))
    verdict = F.when(html.rlike(APP_MARKS) & (n < 2500), "SPA").when(n < 800, "thin").otherwise("plain")
    return F.struct(n.cast("long").alias("n_text"), F.regexp_count(html, F.lit(r"(?i)<script\b")).cast("long").alias("scripts"), verdict.alias("verdict"))
