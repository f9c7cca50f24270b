"""Text functions: folding, normalisers, tokens, HTML, similarity. Built-in expressions where they exist, Arrow functions for
Unicode folding, HTML and sequence similarity, which have none."""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterable
from difflib import SequenceMatcher
from functools import lru_cache
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

# Fixed values.
STOP_WORDS = ("les", "des", "une", "pour", "dans", "avec", "cette", "aux", "sont", "nous", "vous", "ils", "elles", "comme", "leur", "leurs", "mais", "notre", "votre", "sans", "sous", "vers", "par")
CLASSIFIER_STOP_WORDS = ("avec", "aux", "chez", "dans", "des", "dune", "dun", "elle", "elles", "est", "ils", "les", "leur", "leurs", "mais", "notre", "nous", "par", "plus", "pour", "sans", "ses", "son", "sont", "sous", "sur", "une", "vers", "vos", "vous")
GENERIC_TITLE_WORDS = ("developpeur", "developer", "consultant", "ingenieur", "chef", "projet", "data", "technicien", "administrateur")
LEGAL_FORMS = "sa|sas|sasu|sarl|eurl|snc|sci|selarl"
GENDER_MARKS = "h/f/x|f/h/x|h/f|f/h|h-f|f-h|hf|fh|m/f"
BLOCK_TAGS = ("p", "div", "br", "li", "ul", "ol", "h1", "h2", "h3", "h4", "h5", "h6")
SILENT_TAGS = ("script", "style", "template")
GENERIC_COMPANY_WORDS = ("group", "france", "services", "consulting", "technologies", "solutions", "it")

# Replacements.
_TIDY = ((r"[^\w\s]", " "), (r"\s+", " "))
#: Replacements by kind of text, in order, after folding.
_STEPS = {
    "company": ((r"['’]", " "), (r"[+&/]", " "), (rf"\b({LEGAL_FORMS})\b", " "), (r"\bgroupe\s*$", " "), *_TIDY),
    "locality": ((r"[-'’]", " "), (r"\b(ville de|commune de|cedex)\b", " "), *_TIDY),
    "title": (
        (rf"\b({GENDER_MARKS})\b", " "), (r"\bc\+\+", "cpp"), (r"\bc#", "csharp"), (r"\b\.net\b", "net"), (r"\b(back|front)[- ]end\b", r"\1end"),
        (r"(?<!\w)[/-]|[/-](?!\w)", " "), (r"[^\w\s/-]", " "), (r"\s+", " "),
    ),
    "description": _TIDY,
    "key": _TIDY,
}
_COMPILED = {k: tuple((re.compile(a), b) for a, b in v) for k, v in _STEPS.items()}


def fold_text(s: str | None) -> str:
    """NFKC, case-fold, without combining marks."""
    if not s:
        return ""
    if s.isascii():
        return s.lower()
    return "".join(c for c in unicodedata.normalize("NFD", unicodedata.normalize("NFKC", s).casefold()) if unicodedata.category(c) != "Mn")


class _Visible(HTMLParser):
    """The text of a page; block tags and comments separate words, scripts and styles are left out."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts, self.silent = [], 0

    def handle_starttag(self, tag, attrs):
        self.silent += tag in SILENT_TAGS
        if tag == "br":
            self.parts.append(" ")

    def handle_endtag(self, tag):
        self.silent = max(0, self.silent - (tag in SILENT_TAGS))
        if tag in BLOCK_TAGS:
            self.parts.append(" ")

    def handle_data(self, data):
        if not self.silent:
            self.parts.append(data)


def visible_text(markup: str | None) -> str:
    if not markup:
        return ""
    page = _Visible()
    page.feed(markup)
    page.close()
    return "".join(page.parts)


def clean(s: str | None) -> str | None:
    """NFKC, entities resolved, white space collapsed; nothing left is null."""
    if s is None:
        return None
    return " ".join(html.unescape(unicodedata.normalize("NFKC", s)).split()) or None


def normal(kind: str, s: str | None) -> str:
    if kind == "description":
        s = visible_text(html.unescape(s or ""))
    s = fold_text(s)
    for pattern, to in _COMPILED[kind]:
        s = pattern.sub(to, s)
    return s.strip()


#: Texts that a function holds as Python strings at once.
AT_A_TIME = 1000


def _arrow(f, type_=pa.string()):
    """An Arrow function of f, not one over iterators: Spark gives each of those a Python worker of its own in every task, while
    all others of a select share one. Of a batch's texts few are Python strings at a time."""

    @F.arrow_udf(StringType())
    def g(values: pa.Array) -> pa.Array:
        parts = [pa.array([f(v) for v in values.slice(i, AT_A_TIME).to_pylist()], type_) for i in range(0, len(values), AT_A_TIME)]
        return pa.concat_arrays(parts) if parts else pa.array([], type_)

    return g


fold = _arrow(fold_text)
normalize_company = _arrow(lambda s: normal("company", s))
normalize_locality = _arrow(lambda s: normal("locality", s))
normalize_title = _arrow(lambda s: normal("title", s))
normalize_description = _arrow(lambda s: normal("description", s))
#: A text as a key of duplicates; null and blank are the empty key.
dedup_key = _arrow(lambda s: normal("key", s))
_all_descriptions = _arrow(lambda values: " ".join(normal("description", v) for v in values if v) if values is not None else "")
clean_text = _arrow(clean)
html_text = _arrow(lambda s: clean(visible_text(s)))
#: Name of a skill for comparisons: cleaned, decomposed, without combining marks, lower case.
skill_key = _arrow(lambda s: "".join(c for c in unicodedata.normalize("NFKD", clean(s) or "") if not unicodedata.combining(c)).lower() or None)


@lru_cache(50_000)
def ratio(a: str, b: str) -> float:
    """Ratcliff-Obershelp similarity; it isn't symmetric, and long texts leave out frequent characters."""
    return SequenceMatcher(None, a, b).ratio()


#: SequenceMatcher leaves out frequent characters of second texts of this length and more.
AUTOJUNK = 200
#: Pairs compared in one step: their tables of common runs stay in a core's cache.
AT_ONCE = 2048


def _longest(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(length, end in x, end in y) of the longest common run of each column, the first by its place in x, then in y."""
    n = x.shape[1]
    size, end_x, end_y = np.zeros(n, np.uint8), np.zeros(n, np.int64), np.zeros(n, np.int64)
    runs = np.zeros((y.shape[0] + 1, n), np.uint8)  # runs[j]: the common run that ends at the last row of x and before y[j]
    for i in range(x.shape[0]):
        now = runs[:-1] + np.uint8(1)
        now *= y == x[i]
        longer = np.flatnonzero(now.max(axis=0) > size)
        if len(longer):
            cut = now[:, longer]
            end_y[longer] = j = cut.argmax(axis=0)
            size[longer], end_x[longer] = cut[j, np.arange(len(longer))], i
        runs[1:] = now
    return size.astype(np.int64), end_x + 1, end_y + 1


def _coded(xs: np.ndarray, ys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both sides' texts as columns of numbers, a byte each where few characters occur; what fills them up equals nothing."""
    codes = [np.array([*v, ""]).view(np.uint32).reshape(len(v) + 1, -1) for v in (xs, ys)]
    known, inverse = np.unique(np.concatenate([c.ravel() for c in codes]), return_inverse=True)
    if len(known) < 254:
        inverse = inverse.reshape(-1)
        codes = [(part + 1).astype(np.uint8).reshape(c.shape) for c, part in zip(codes, np.split(inverse, [codes[0].size]))]
    top = np.iinfo(codes[0].dtype).max
    for c, v, none in zip(codes, (xs, ys), (top, top - 1)):
        c[np.arange(c.shape[1]) >= np.fromiter(map(len, [*v, ""]), np.int64, len(v) + 1)[:, None]] = none
    return tuple(np.ascontiguousarray(c.T) for c in codes)


def matched(xs: np.ndarray, ys: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many characters SequenceMatcher's matching blocks of xs[x] and ys[y] hold, for each pair of texts of 1 to AUTOJUNK - 1
    characters.

    All pairs take their longest common run at once, then those left and right of it, until none is left. Texts are coded once,
    however many pairs they are in."""
    codes = _coded(xs, ys)
    top = np.iinfo(codes[0].dtype).max
    lengths = [np.fromiter(map(len, v), np.int32, len(v))[at] for v, at in ((xs, x), (ys, y))]
    total = np.zeros(len(x), np.int64)
    none = np.zeros(len(x), np.int32)
    open_, whole = np.stack([np.arange(len(x), dtype=np.int32), none, lengths[0], none, lengths[1]]), True
    while open_.shape[1]:
        open_ = open_[:, np.argsort(((open_[2] - open_[1]) * 256 + open_[4] - open_[3]).astype(np.uint16), kind="stable")]
        more = []
        for at in range(0, open_.shape[1], AT_ONCE):
            p, x0, x1, y0, y1 = work = open_[:, at : at + AT_ONCE]
            sides = []
            for c, of, low, high, end in ((codes[0], x[p], x0, x1, top), (codes[1], y[p], y0, y1, top - 1)):
                longest = (high - low).max()
                if whole:
                    sides.append(c[:longest].take(of, axis=1))
                else:
                    place = low + np.arange(longest, dtype=np.int32)[:, None]
                    sides.append(np.where(place < high, c[np.minimum(place, c.shape[0] - 1), of], c.dtype.type(end)))
            size, x2, y2 = _longest(*sides)
            total += np.bincount(p, size, len(x)).astype(np.int64)
            size, x2, y2 = size.astype(np.int32), x0 + x2.astype(np.int32), y0 + y2.astype(np.int32)
            left, right = np.stack([p, x0, x2 - size, y0, y2 - size]), np.stack([p, x2, x1, y2, y1])
            more += [w[:, (size > 0) & (w[2] > w[1]) & (w[4] > w[3])] for w in (left, right)]
        open_, whole = np.concatenate(more, axis=1), False
    return total


def ratios(a: Iterable[str | None], b: Iterable[str | None]) -> np.ndarray:
    """ratio() of each pair, 0 if either is null; equal pairs are compared once."""
    (i, xs), (j, ys) = (pd.factorize(np.fromiter(v, object)) for v in (a, b))
    out = np.zeros(len(i))
    known = np.flatnonzero((i >= 0) & (j >= 0))
    if not len(known):
        return out
    at, pairs = pd.factorize(i[known] * np.int64(len(ys)) + j[known])
    x, y = pairs // len(ys), pairs % len(ys)
    n, m = (np.fromiter(map(len, v), np.int64, len(v)) for v in (xs, ys))
    short = lambda v, n: np.where((n > 0) & (n < AUTOJUNK), v, "")
    quick = (n[x] > 0) & (m[y] > 0) & (n[x] < AUTOJUNK) & (m[y] < AUTOJUNK)
    found = np.zeros(len(pairs))
    if quick.any():
        found[quick] = 2.0 * matched(short(xs, n), short(ys, m), x[quick], y[quick]) / (n[x] + m[y])[quick]
    found[~quick] = [ratio(xs[k], ys[l]) for k, l in zip(x[~quick], y[~quick])]
    out[known] = found[at]
    return out


@F.pandas_udf(DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """ratio() of two short texts; 0 if either is null."""
    return pd.Series(ratios(a, b))


def characters(s: Column) -> Column:
    """A text's characters as numbers that tell repeated ones apart, so that two texts share as many of them as characters with
    their counts; an array of whole numbers."""
    c = F.array_sort(F.filter(F.split(s, ""), lambda x: x != ""))
    whole = F.array_join(c, "")
    return F.transform(c, lambda x, i: F.ascii(x) * 1024 + F.least(i + 1 - F.instr(whole, x), F.lit(1023)).cast("int"))


def ratio_bound(a: Column, b: Column, in_a: Column, in_b: Column) -> Column:
    """What the similarity of two texts can reach at most, as both orders of them: twice their common characters(), counts
    included, over both lengths; 0 if both are empty. Lengths alone decide where they can."""
    n = F.length(a) + F.length(b)
    return F.when(n > 0, 2.0 * F.least(F.length(a), F.length(b), F.size(F.array_intersect(in_a, in_b))) / n).otherwise(0.0)


@F.pandas_udf(DoubleType())
def round_even(x: pd.Series, digits: pd.Series) -> pd.Series:
    """Rounding of the exact binary value, halves to even."""
    return pd.Series([None if pd.isna(v) else round(float(v), int(d)) for v, d in zip(x, digits)])


def tokens(normal_text: Column, stop_words=STOP_WORDS) -> Column:
    """Sorted distinct words of three letters or more, without stop words and numbers."""
    words = F.filter(F.split(normal_text, r"\s+"), lambda w: (F.length(w) >= 3) & ~w.isin(*stop_words) & ~w.rlike("^[0-9]+$"))
    return F.array_sort(F.array_distinct(words))


def skill_tokens(skills: Column, fields: tuple[str, ...] = ("name_normalized", "name", "slug")) -> Column:
    """The classifier's tokens of skills, an array of structs; each field is normalised by itself."""
    values = F.flatten(F.transform(skills, lambda s: F.array(*[s[f] for f in fields])))
    return tokens(_all_descriptions(F.array_compact(values)), CLASSIFIER_STOP_WORDS)


def compact(s: Column) -> Column:
    return F.regexp_replace(s, r"\s", "")


def blank_to_null(s: Column) -> Column:
    return F.nullif(F.trim(s), F.lit(""))


def excerpt(s: Column, n: int = 150) -> Column:
    t = F.trim(s)
    return F.when(F.length(t) > n, F.concat(F.left(t, F.lit(n)), F.lit("..."))).otherwise(t)


def one_line(s: Column) -> Column:
    return F.trim(F.translate(s, "\r\n", "  "))


def is_generic_title(toks: Column) -> Column:
    """Fewer than three words, or none but generic ones."""
    return (F.size(toks) < 3) | (F.size(F.array_except(toks, F.array(*map(F.lit, GENERIC_TITLE_WORDS)))) == 0)


def is_generic_title_for_classes(title_tokens: Column, skill_tokens: Column) -> Column:
    """No skill word, and one title word at most or none but generic ones."""
    return (F.size(skill_tokens) == 0) & ((F.size(title_tokens) <= 1) | (F.size(F.array_except(title_tokens, F.array(*map(F.lit, GENERIC_TITLE_WORDS)))) == 0))


def fingerprint_keys(title: Column, company: Column, postal: Column, description: Column) -> Column:
    """Four keys of an offer; empty parts count."""
    e = lambda c: F.coalesce(c, F.lit(""))
    t, c, p, d = map(e, (title, company, postal, description))
    return F.array(F.concat_ws("|", F.lit("tcp"), t, c, p), F.concat_ws("|", F.lit("tp"), t, p), F.concat_ws("|", F.lit("ct"), c, t), F.concat_ws("|", F.lit("td"), t, F.sha2(d, 256)))


def skills_in_text(skills: Column, text: Column) -> Column:
    """Whether a text names the skills: one of one, or two of several."""
    hits = F.size(F.filter(skills, lambda s: F.contains(text, s)))
    return hits >= F.when(F.size(skills) <= 1, 1).otherwise(2)


# Patterns of an intermediary, and weaker markers.
INTERMEDIARY_PATTERNS = (
    "pour le compte de (?:notre|son|un|une) client",
    "notre client (?:recherche|recrute|souhaite|est)",
    "cabinet de recrutement",
    "nous accompagnons (?:notre|un|une) client",
    "client final",
    "mission chez (?:notre|un|une) client",
    "recrute pour (?:son|un|une|notre) client",
    "pour l['’]un de nos clients",
)
CLIENT_MARKERS = ("notre client", "nos clients", "un client", "le client")


def advertiser_role(*texts: Column, patterns=INTERMEDIARY_PATTERNS, markers=CLIENT_MARKERS) -> Column:
    """struct(role, evidence): what the texts say about who advertises."""
    parts = [F.nullif(F.trim(F.regexp_replace(F.lower(t), r"\s+", " ")), F.lit("")) for t in texts]
    all_ = F.concat_ws("\n", *parts)
    strong = F.array_compact(F.array(*[F.nullif(F.regexp_extract(all_, p, 0), F.lit("")) for p in patterns]))
    weak = F.array_compact(F.array(*[F.when(F.contains(all_, F.lit(m)), F.lit(m)) for m in markers]))
    role = F.when(all_ == "", "UNKNOWN").when(F.size(strong) > 0, "RECRUITMENT_INTERMEDIARY").when(F.size(weak) > 0, "POSSIBLE_INTERMEDIARY").otherwise("DIRECT_EMPLOYER")
    evidence = F.when(F.size(strong) > 0, strong).when(F.size(weak) > 0, F.slice(weak, 1, 1)).otherwise(F.array().cast("array<string>"))
    return F.struct(role.alias("role"), evidence.alias("evidence"))


def is_legacy_url(url: Column, legacy: str = "/job_postings/") -> Column:
    """Whether a link's path, without host and query, is a legacy one; false for null."""
    return F.coalesce(F.contains(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1), F.lit(legacy)), F.lit(False))


def resolve_url(candidates: list[str | None], raw_id: str | None, fallback: str | None, base: str, domain: str, legacy: str = "/job_postings/") -> tuple[str | None, str | None, str]:
    """(raw, absolute, method) of an offer's link: trimmed links first, then the id, then the fallback, each made absolute.

    A link is usable if it is http or https, on the domain and not a legacy one. A legacy id or fallback is kept as it is, on any host."""
    tidy = lambda u: (u or "").strip()

    def classify(u: str) -> tuple[str, str | None]:
        full = urljoin(base, u)
        parts = urlsplit(full)
        if legacy in parts.path:  # on whatever host
            return "legacy", None
        if parts.scheme not in ("http", "https") or not f".{parts.hostname or ''}".endswith(f".{domain}"):
            return "foreign", None
        return "usable", full

    ladder = [(tidy(u), False) for u in candidates] + [(tidy(raw_id), True), (tidy(fallback), True)]
    for u, keeps_legacy in ladder:
        kind, full = classify(u) if u else ("none", None)
        if kind == "usable":
            return u, full, "RAW_ABSOLUTE_URL" if urlsplit(u).scheme else "RELATIVE_HREF_RESOLVED"
        if kind == "legacy" and keeps_legacy:
            return u, None, "LEGACY_URL_REBUILT"
    return None, None, "URL_UNAVAILABLE"


def url_resolution(candidates: Column, raw_id: Column, fallback: Column, base: str, domain: str) -> Column:
    """resolve_url() over columns: struct(raw, absolute, method)."""

    @F.pandas_udf("raw string, absolute string, method string")
    def f(c: pd.Series, i: pd.Series, b: pd.Series) -> pd.DataFrame:
        rows = [resolve_url(list(x) if x is not None else [], y, z, base, domain) for x, y, z in zip(c, i, b)]
        return pd.DataFrame(rows, columns=["raw", "absolute", "method"])

    return f(candidates, raw_id, fallback)
