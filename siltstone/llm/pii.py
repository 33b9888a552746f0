"""Personal details inside free text, found and replaced with typed placeholders.

Weak-supervision aggregation. One pass over whole texts proposes spans of each kind and lets labelers vote on
each: patterns of the kind's formats, a gazetteer of words that are no names, cues in the words before and
after, and, for names of people, the corpus itself. No list of names is used: words that texts also write small
speak against a name; words that meet different partners as first and as last word of spans speak for it, for
given and family names recombine and headings don't; so does an e-mail address that holds one of them. Those
statistics are counters of hashed words, of one size whatever the corpus.

A span's votes (for, against, none) form a pattern; there are few patterns, however large the corpus.
Expectation-maximisation over the patterns of all spans estimates how reliable each labeler is, without labels.
The final span classifier is trained on these posteriors as soft labels: a logistic model per kind over the votes
and the words around the span, so that contexts learned where votes are clear decide where they aren't. It is
fitted to at most TRAINING spans, drawn by hash, and scores every span; overlapping spans go to the surest, then
the longest.

Defined results: null and blank texts hold nothing. A detail is reported once per document and kind as it is
written. Repeated rows with one doc_id are one document in the list of details; when redacting, each row keeps its
own text. Spans never cross a line break.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.runtime import Scratch

KINDS = ("email", "phone", "id_number", "street_address", "person_name")
COUNTERS = 1 << 22  # of hashed words
TRAINING = 20_000  # spans the classifier is fitted to, at most
HASHED = 1 << 12  # hashed words of contexts, per kind

# Words that are no part of a person's name: kinds of streets and places, firms, functions, products.
NO_NAME = (
    "street st avenue ave road rd lane court boulevard blvd drive harbour harbor campus office square park bridge "
    "systems labs group health media works logistics finance energy analytics inc ltd llc corp gmbh ag data engineer developer analyst architect manager "
    "director recruiter product platform software senior junior lead staff principal team bi etl ml the and for with dr mr ms mrs prof frau herr "
    "spark python trino kafka scala java rust sql git docker kubernetes terraform airflow dbt postgres parquet iceberg flink looker apt suite"
).split()

_SP = r"[ \xa0 ]"
_DOM = r"[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?"
_LOCAL = r"(?<![A-Za-z0-9._%+@-])[A-Za-z0-9](?:[A-Za-z0-9._%+-]*[A-Za-z0-9_+-])?"
EMAIL = re.compile(
    rf"{_LOCAL}(?:@{_DOM}(?:\.{_DOM})+"
    rf"|{_SP}?[(\[{{](?:at|@)[)\]}}]{_SP}?{_DOM}(?:(?:\.|{_SP}?[(\[{{]dot[)\]}}]{_SP}?){_DOM})+"
    rf"|{_SP}at{_SP}{_DOM}(?:{_SP}dot{_SP}{_DOM})+)",
    re.IGNORECASE,
)
# Number plans, each with or without the country code.
PLANS = (
    rf"(?:(?:\+|00)?1[ \xa0.-]?)?(?:\([2-9]\d{{2}}\){_SP}?|[2-9]\d{{2}}[ \xa0.-]?)[2-9]\d{{2}}[ \xa0.-]?\d{{4}}",
    rf"(?:(?:\+|00)44{_SP}?(?:\(0\){_SP}?)?|\(?0)(?:20\)?[ \xa0-]?\d{{4}}[ \xa0-]?\d{{4}}|[17]\d{{3}}\)?[ \xa0-]?\d{{6}}|[17]\d{{2}}\)?[ \xa0-]?\d{{3}}[ \xa0-]?\d{{4}})",
    rf"(?:(?:\+|00)49{_SP}?(?:\(0\){_SP}?)?|\(?0)(?:30|40|69|89|[1-9]\d{{2,3}})\)?(?:{_SP}?/{_SP}?|[ \xa0-])?\d{{4,6}}[ \xa0-]?\d{{2,4}}",
    r"(?:(?:\+|00)34[ \xa0.-]?)?[6-9]\d{2}(?:[ \xa0.-]?\d{3}[ \xa0.-]?\d{3}|[ \xa0.-]\d{2}[ \xa0.-]\d{3}[ \xa0.-]\d{2}|(?:[ \xa0.-]\d{2}){3}(?!\d))",
    rf"(?:(?:\+|00)33{_SP}?(?:\(0\){_SP}?)?|0)[1-9](?:[ \xa0.-]?\d{{2}}){{4}}",
)
_PLAN = re.compile("|".join(f"(?:{p})" for p in PLANS))
PHONE = re.compile(rf"(?<![\w@/#(.,+-])(?<!\d{_SP})(?:{'|'.join(f'(?:{p})' for p in PLANS)}|\+\d{{1,3}}(?:[ \xa0.()/-]{{0,3}}\d{{2,5}}){{2,5}})(?![\w@]|[.,/-]\d|{_SP}\d)")
ID = re.compile(
    rf"(?<![\w@/#.,+-])(?<!\d{_SP})(?:\d{{3}}-\d{{2}}-\d{{4}}|\d{{3}}\.\d{{3}}\.\d{{3}}-\d{{2}}|[A-Z]{{2}}{_SP}?\d{{2}}{_SP}?\d{{2}}{_SP}?\d{{2}}{_SP}?[A-D]"
    rf"|[12]{_SP}?\d{{2}}{_SP}?\d{{2}}{_SP}?\d{{2}}{_SP}?\d{{3}}{_SP}?\d{{3}}(?:{_SP}?\d{{2}})?|\d{{2}}{_SP}\d{{3}}{_SP}\d{{3}}{_SP}\d{{3}}"
    rf"|\d{{2}}\.\d{{3}}\.\d{{3}}-?[A-Z]|\d{{8}}[ -]?[A-Z]|[XYZ]-?\d{{7}}-?[A-Z]|\d{{11}}|\d{{9}})(?![\w@]|[.,/-]\d|{_SP}\d)"
)
_UP = "A-ZÀ-ÖØ-Þ"
_NAME = rf"[{_UP}][\w'’-]+"
_TYPES = r"Street|St|Avenue|Ave|Road|Rd|Lane|Ln|Court|Ct|Boulevard|Blvd|Drive|Dr|Way|Place|Pl|Terrace|Square|Sq"
ADDRESS = re.compile(
    rf"(?<![\w.,-])(?:\d{{1,5}}[A-Za-z]?{_SP}(?:[NSEW]\.{_SP})?(?:{_NAME}{_SP}){{1,3}}?(?:{_TYPES})(?!\w)"
    rf"|(?:{_NAME}{_SP})?[{_UP}][\w-]*(?:straße|strasse|str\.|weg|gasse|platz|allee|ufer|damm|ring|(?<=[a-zß ])(?:Straße|Weg|Allee|Platz)){_SP}?\d{{1,4}}(?:{_SP}?[a-z](?!\w))?(?!\w)"
    rf"|\d{{1,4}}(?:{_SP}?(?:bis|ter))?,?{_SP}(?:rue|avenue|boulevard|chemin|place|allée|quai|impasse|cours)(?:{_SP}(?:de{_SP}la|du|des|de|la|le))?(?:{_SP}|{_SP}d['’]){_NAME}(?:{_SP}{_NAME}(?=[,.\n<]))?"
    rf"|(?:[Cc]alle|C/|[Aa]venida|Avda\.?|Av\.|[Pp]laza|[Pp]aseo|[Cc]amino|[Rr]onda){_SP}?(?:de{_SP}la{_SP}|del{_SP}|de{_SP})?{_NAME}(?:{_SP}{_NAME})?,?{_SP}(?:n[º°o]?\.?{_SP}?)?\d{{1,4}}(?:{_SP}?[a-z](?![\wº]))?(?!\w))"
)
# A name begins at any capital word, so the search looks ahead and spans may overlap.
PERSON = re.compile(rf"(?<![\w@.'’-])(?=((?:{_NAME},{_SP}{_NAME}|{_NAME}{_SP}(?:[{_UP}]\.{_SP})?{_NAME}|[{_UP}]\.{_SP}(?:[{_UP}]\.{_SP})?{_NAME})))(?=[{_UP}])")
_BEFORE_NAME = re.compile(rf"(?<![\w@.'’-]){_NAME}{_SP}$")

# Cheap anchors: the full patterns are tried only around them.
_AT = re.compile(r"@|[(\[{](?:at|@)[)\]}]|\sat\s(?=\S+\sdot\s)", re.IGNORECASE)
_DIGITS = re.compile(r"\d[\d \xa0\u202f.()/-]{4,}\d")
_NUMBER = re.compile(r"\d{1,5}")
# What follows a number, stands before it, or stands somewhat before it in an address.
_STREET_AFTER = re.compile(rf"[A-Za-z]?,?{_SP}(?:(?:bis|ter),?{_SP})?(?:[NSEW]\.{_SP})?(?:{_NAME}{_SP}|rue|avenue|boulevard|chemin|place|allée|quai|impasse|cours)")
_STREET_BEFORE = ("straße", "strasse", "str.", "weg", "gasse", "platz", "allee", "ufer", "damm", "ring")
_STREET_ABOUT = ("calle", "c/", "avenida", "avda", "av.", "plaza", "paseo", "camino", "ronda")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def _addresses(text: str, back: int = 128, ahead: int = 200) -> Iterator[re.Match]:
    """Street addresses: every form has a number, so the full pattern is tried only around numbers with a sign of a street."""
    done = 0
    for n in _NUMBER.finditer(text):
        a, b = n.span()
        if a < done:
            continue
        head = text[max(0, a - back) : a].lower()
        if head.rstrip(" \xa0\u202f").endswith(_STREET_BEFORE) or _STREET_AFTER.match(text, b) or any(k in head for k in _STREET_ABOUT):
            limit = min(len(text), b + ahead)
            for m in ADDRESS.finditer(text, max(done, a - back), limit):
                # one that reaches the end of the stretch is matched again on the whole text
                m = (ADDRESS.match(text, m.start()) or m) if m.end() > limit - 8 else m
                done = m.end()
                yield m


def _mails(text: str) -> Iterator[re.Match]:
    """E-mail addresses of any length: from each sign of one back to where its local part begins."""
    low = text.lower()
    if "@" not in low and "at]" not in low and "at)" not in low and "at}" not in low and "dot" not in low:
        return
    done = 0
    for sign in _AT.finditer(text):
        end = sign.start()
        if end and text[end - 1] in " \xa0\u202f":
            end -= 1
        start = end
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        while start < end and not text[start].isalnum():
            start += 1
        if start >= done and (m := EMAIL.match(text, start)):
            done = m.end()
            yield m


def _near(anchors: list[tuple[int, int]], pattern: re.Pattern, text: str, back: int, ahead: int) -> Iterator[re.Match]:
    """Matches of a pattern that touch the surroundings of its anchors, each once."""
    done = 0
    for start, end in anchors:
        for m in pattern.finditer(text, max(done, start - back), min(len(text), end + ahead)):
            done = m.end()
            yield m


# Cues in the words before a span; each list is one labeler's.
_CUES = {
    "email": r"(?:e-?mail|mail|contact|kontakt|contacto|mailto:|correo|courriel|write to|send|escribe|écrivez|[<|,/])[^.!?]{0,40}$",
    "phone": r"(?:\btel|phone|\bcall|\btext|telefon|teléfono|tél|llama|appelez|mobile?|móvil|handy|reach|unter|fax|whatsapp|[|,/>])[^.!?\d]{0,14}[.:]?[^\w]{0,4}$",
    "id_number": r"(?:ssn|social security|tax id|itin|cpf|nino|ni number|national insurance(?: no\.?)?|idnr\.?|steuer-?id(?:nr\.?)?|nir|sécurité sociale|insee|dni|nie|nif|documento|ausweis\w*|passport|id number)(?: number| no\.?| nr\.?| n[º°])?[\s:]*$",
    "street_address": r"(?:\bat|address|anschrift|adresse|dirección|domicilio|\bau|\ben|(?:in|an) der|wohnhaft|\bto)[^.!?]{0,25}$",
}
CUES = {k: re.compile(v, re.IGNORECASE) for k, v in _CUES.items()}
# Words, alone or in twos, that come before a person's name: roles, titles, and words that lead to people.
CALLED = frozenset(
    "recruiter|kontakt|contact|contacto|responsable|ansprechperson|ansprechpartner|ansprechpartnerin|manager|candidate|name|nombre|nom|ask for|spoke to|demandez|pregunta por|preguntar por|pregunte por|fragen nach|"
    "hablé con|with|by|mit|con|por|avec|par|von|dr.|mr|mr.|ms|ms.|mrs|mrs.|frau|herr|sr.|sra.|mme|m.".split("|")
)
# Labels of numbers that identify things, not people.
AGAINST = re.compile(r"(?:invoice|order|reference|ref|code|build|version|ticket|requisition|\bip|section|\bjob|isbn|sku|rechnung|bestellung|auftrag|factura|facture|pedido|commande|referencia|référence)(?:\s(?:no|nr|number|string|code|n[º°])\b\.?)?\W{0,3}$", re.IGNORECASE)
AFTER_NO = {
    "phone": re.compile(rf"{_SP}?(?:%|[kMG]B\b|ms\b|km\b|kg\b|[a-z]+s\b)"),
    "id_number": re.compile(rf"{_SP}?(?:%|[kMG]B\b|ms\b|km\b|kg\b|[a-z]+s\b)"),
    "person_name": re.compile(rf"{_SP}?(?:&|(?:Inc|Ltd|LLC|GmbH|AG|SA|Group|Street|Avenue|Road|Campus|Office|Harbou?r|Park|Square|University|Labs|Works|Systems)\b)"),
}
AFTER_YES = {
    "email": re.compile(r"\s?(?:[>|,/]|</a>)"),
    "phone": re.compile(r"\s?(?:ext\b|[|,])"),
    "id_number": re.compile(r"\s?[.<\n]"),
    "street_address": re.compile(r",?\s?(?:suite|apt|unit|\d{5}|\d+º|[A-Z]{2} \d{5}|hinterhaus|bât|piso|etage|esc)", re.IGNORECASE),
    "person_name": re.compile(r"\s?(?:[|<(]|, [+(\d]|, \S+(?:@|\s?[(\[]at|\sAT\s))"),
}
_FORMS = {
    "email": re.compile(r".*[A-Za-z][A-Za-z]+$", re.DOTALL),
    "phone": _PLAN,
    "id_number": re.compile(r"(?!.*-00-)(?!000-)(?!\d{8}$)(?:.*)$", re.DOTALL),
}
_NO_NAME = frozenset(NO_NAME)
_LAST_WORDS = re.compile(r"(\w+)\W*(\w+)?\W*$")
_NEXT_WORD = re.compile(r"\W*(\w+)?\W*(\w+)?")
_DIGIT = re.compile(r"\d+")
UNIT, LINE = "\x1f", "\x1e"


def _sign(yes: bool, no: bool = False) -> str:
    return "-" if no else "+" if yes else "0"


def _inside(text: str, a: int) -> bool:
    """Whether initials are the middle of a longer name: after a capital word."""
    return _BEFORE_NAME.search(text, max(0, a - 64), a) is not None


def letters(word: str) -> str:
    """The letters of a word, small and without accents."""
    if word.isascii() and word.isalpha():
        return word.lower()
    return "".join(c for c in unicodedata.normalize("NFKD", word).casefold() if c.isalpha())


def first_and_last(name: str) -> tuple[str, str]:
    """Given name (or initial) and family name of a name-shaped span, in small letters."""
    if "," in name:
        last, first = name.split(",", 1)
    else:
        words = name.split()
        first, last = words[0], words[-1]
    return first.strip().lower().replace("’", "'"), last.strip().lower().replace("’", "'")


def around_words(text: str, a: int, b: int) -> tuple[str, str]:
    """The word before and the word after a span with the marks that part them, numbers as one."""
    before, after = text[max(0, a - 40) : a].rpartition("\n")[2], text[b : b + 40].partition("\n")[0]
    w = before.split()
    v = after.split()
    return _DIGIT.sub("9", w[-1].lower()) if w else "", _DIGIT.sub("9", (after[:1].strip() and after[:1]) + v[0].lower()) if v else ""


def spans(text: str) -> list[tuple[str, int, int, str, str]]:
    """Proposed spans of a text: kind, start, end, votes of the kind's labelers (+, -, 0), words around. The first three
    votes on a name are the corpus' and come later (?)."""
    out = []
    mails = []

    def add(kind: str, a: int, b: int, first: str) -> None:
        before, after = text[max(0, a - 48) : a], text[b : b + 40]
        no = AFTER_NO.get(kind)
        votes = first + _sign(bool(CUES[kind].search(before))) + _sign(False, bool(AGAINST.search(before))) + _sign(bool(AFTER_YES[kind].match(after))) + _sign(False, no is not None and bool(no.match(after)))
        out.append((kind, a, b, votes, "\x1d".join(around_words(text, a, b))))

    for m in _mails(text):
        t = m.group(0)
        local = re.split(r"@|\s?[(\[{](?:at|@)[)\]}]\s?|\sat\s", t, maxsplit=1, flags=re.IGNORECASE)[0]
        mails.append(letters(local))
        good = bool(re.search(r"[A-Za-z]{2,}$", t)) and bool(re.search(r"[A-Za-z]", local))
        add("email", m.start(), m.end(), _sign(good, not good) + _sign("@" in t, not re.search("[A-Za-z]", local)))
    numbers = [n.span() for n in _DIGITS.finditer(text)]
    for m in _near(numbers, PHONE, text, 3, 3):
        t = m.group(0)
        plan = bool(_PLAN.fullmatch(t))
        n = sum(c.isdigit() for c in t)
        spaced = bool(re.search(r"[ \xa0.()/-]", t))
        add("phone", m.start(), m.end(), _sign(plan and 9 <= n <= 15, not plan) + _sign(t[0] == "+" or spaced, bool(CUES["id_number"].search(text[max(0, m.start() - 48) : m.start()]))))
    for m in _near(numbers, ID, text, 4, 4):
        t = m.group(0)
        before = text[max(0, m.start() - 48) : m.start()]
        called = bool(CUES["phone"].search(before)) and not CUES["id_number"].search(before)
        odd = bool(re.search(r"^\d{3}-00-|^000-\d\d-|^0{9}", t))
        lettered = bool(re.search(r"[A-Z]$|^\d{3}\.\d{3}\.\d{3}-\d\d$|^\d{3}-\d\d-\d{4}$|^[12]\s\d\d\s", t))
        if called and not lettered and _PLAN.fullmatch(t):
            continue
        add("id_number", m.start(), m.end(), _sign(lettered, odd) + "0")
    for m in _addresses(text):
        number = re.search(r"\d+", m.group(0))
        add("street_address", m.start(), m.end(), _sign(True, int(number.group(0)) > 20000) + "0")
    after_yes, after_no = AFTER_YES["person_name"], AFTER_NO["person_name"]
    for m in PERSON.finditer(text):
        t, a, b = m.group(1), m.start(1), m.end(1)
        first, last = first_and_last(t)
        x, y = letters(first), letters(last)
        mailed = bool(mails) and any((len(y) > 2 and y in g) or (len(x) > 2 and x in g) for g in mails)
        called, followed = _called(text, a), after_yes.match(text, b) is not None
        # two capital words apart by a comma are mostly a list: such a name needs a cue on either side, or an address
        if "," in t and not (mailed or called or followed):
            continue
        bad = first in _NO_NAME or last in _NO_NAME
        inside = len(x) == 1 and _inside(text, a)
        out.append(("person_name", a, b, "???" + _sign(mailed and not inside, bad or inside) + _sign(called) + _sign(followed) + _sign(False, after_no.match(text, b) is not None), "\x1d".join(around_words(text, a, b))))
    return out


def _called(text: str, a: int) -> bool:
    """Whether a cue of names stands before a place."""
    words = text[max(0, a - 40) : a].rpartition("\n")[2].rpartition(">")[2].lower().replace(":", " ").split()
    return bool(words) and (words[-1] in CALLED and not (words[-1] in ("ms", "m.") and len(words) > 1 and words[-2][-1:].isdigit()) or " ".join(words[-2:]) in CALLED)


def _counter(word: str) -> int:
    return zlib.crc32(word.encode()) % COUNTERS


def packed(docs: list[list[tuple[str, int, int, str, str]]], texts: list[str]) -> list[str]:
    """Spans of each text as one text, fields apart by unit separators."""
    return [LINE.join(UNIT.join((k, str(a), str(b), k + v, c, t[a:b])) for k, a, b, v, c in got) for got, t in zip(docs, texts, strict=True)]


def propose(docs: DataFrame) -> DataFrame:
    """(doc_id, spans): the proposed spans of each document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "spans": packed([spans(t) for t in pdf["text"]], list(pdf["text"]))})

    rows = docs.select("doc_id", "text").filter("doc_id is not null and trim(text) <> ''")
    return rows.mapInPandas(run, "doc_id bigint, spans string").filter("spans <> ''")


def word_statistics(docs: DataFrame, proposed: DataFrame) -> np.ndarray:
    """One byte per hashed word: bit 1 written small in a good part of its texts, bit 4 several partners as a first word,
    bit 8 several as a last word. COUNTERS bytes, whatever the corpus."""
    kind = lambda x: F.get(F.split(x, UNIT), F.lit(0))
    names = F.filter(F.split("spans", LINE), lambda x: kind(x) == "person_name")

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = set()
            for s in pdf["spans"]:
                for x in s.split(LINE):
                    # two capital words apart by a comma are mostly a list, and tell nothing here
                    if x.startswith("person_name") and "," not in (t := x.rsplit(UNIT, 1)[1]):
                        first, last = first_and_last(t)
                        f, g = _counter(first), _counter(last)
                        if len(first) > 2:
                            rows.add((f, 0, zlib.crc32(last.encode()) % 63))
                        rows.add((g, 1, zlib.crc32(first.encode()) % 63))
            yield pd.DataFrame(list(rows), columns=["w", "place", "lot"])

    met = proposed.filter(F.size(names) > 0).mapInPandas(words, "w int, place int, lot int")
    met = met.groupBy("w").agg(*[F.bit_count(F.bit_or(F.when(F.col("place") == p, F.expr("shiftleft(1L, lot)")))).alias(f"partners{p}") for p in (0, 1)])
    # texts per word, written small anywhere and as part of a proposed name
    small = F.array_distinct(F.regexp_extract_all("text", F.lit(r"(?<![\w@.+'’-])([a-zß-öø-ÿ][a-zß-öø-ÿ'’-]++)(?![\w@+]|\.\w|\s?[(\[{]|\s(?:at|dot)\s)"), 1))
    lower = docs.filter("text is not null").select(F.explode(small).alias("t")).select(F.pmod(F.crc32(F.regexp_replace("t", "’", "'").cast("binary")), F.lit(COUNTERS)).cast("int").alias("w"))
    lower = lower.groupBy("w").agg(F.count("*").alias("n_small"))
    both = F.transform(names, lambda x: F.element_at(F.split(x, UNIT), -1))
    capital = proposed.select(F.explode(F.array_distinct(F.flatten(F.transform(both, lambda x: F.split(F.regexp_replace(F.lower(x), "’", "'"), r"[, \u00a0\u202f]+"))))).alias("t"))
    capital = capital.select(F.pmod(F.crc32(F.col("t").cast("binary")), F.lit(COUNTERS)).cast("int").alias("w")).groupBy("w").agg(F.count("*").alias("n_capital"))
    every = capital.join(lower, "w", "left").join(met, "w", "left").select("w", "n_capital", F.coalesce("n_small", F.lit(0)).alias("n_small"), F.coalesce("partners0", F.lit(0)).alias("p0"), F.coalesce("partners1", F.lit(0)).alias("p1"))
    bits = (
        F.when(F.col("n_small") * 4 > F.col("n_capital"), 1).otherwise(0)
        + F.when(F.col("p0") >= 3, 4).otherwise(0)
        + F.when(F.col("p1") >= 3, 8).otherwise(0)
    )
    rows = every.select("w", bits.cast("int").alias("bits")).withColumn("k", F.expr("w div 65536"))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"k": [int(pdf["k"].iloc[0])], "w": [pdf["w"].to_numpy(np.int32).tobytes()], "bits": [pdf["bits"].to_numpy(np.uint8).tobytes()]})

    out = np.zeros(COUNTERS, np.uint8)
    for r in rows.groupBy("k").applyInPandas(pack, "k bigint, w binary, bits binary").collect():
        out[np.frombuffer(r.w, np.int32)] = np.frombuffer(r.bits, np.uint8)
    return out


def settle(votes: str, name: str, statistics: np.ndarray, given: int = 16, family: int = 32) -> str:
    """A name's votes with the corpus' own in place of the question marks; given and family: the bits that speak for a name."""
    first, last = first_and_last(name)
    x, y = int(statistics[_counter(first)]), int(statistics[_counter(last)])
    initial = len(first.rstrip(".")) == 1
    small = _sign(False, y & 1 > 0 or (not initial and x & 1 > 0))
    return votes.replace("???", small + _sign(initial or x & given > 0) + _sign(y & family > 0), 1)


def settled(proposed: DataFrame, statistics: Broadcast) -> DataFrame:
    """Proposed spans with all votes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for s in pdf["spans"]:
                lines = []
                for x in s.split(LINE):
                    k, a, b, v, c, t = x.split(UNIT, 5)
                    lines.append(UNIT.join((k, a, b, settle(v, t, statistics.value), c, t)) if k == "person_name" else x)
                out.append(LINE.join(lines))
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "spans": out})

    return proposed.mapInPandas(run, "doc_id bigint, spans string")


def words_of_names(proposed: DataFrame, statistics: Broadcast) -> DataFrame:
    """(w, bit, p, n): how often a word is met as a given (bit 16) or family name (32) in proposed names of vote pattern p, with
    the first round's votes: words that recombine. Each name has one family name, so those count the names."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows: Counter = Counter()
            for s in pdf["spans"]:
                for x in s.split(LINE):
                    if x.startswith("person_name"):
                        _, _, _, v, _, t = x.split(UNIT, 5)
                        p = settle(v, t, statistics.value, 4, 8)
                        first, last = first_and_last(t)
                        if len(first.rstrip(".")) > 1:
                            rows[_counter(first), 16, p] += 1
                        rows[_counter(last), 32, p] += 1
            yield pd.DataFrame([(*k, n) for k, n in rows.items()], columns=["w", "bit", "p", "n"])

    return proposed.mapInPandas(run, "w int, bit int, p string, n bigint").groupBy("w", "bit", "p").agg(F.sum("n").alias("n"))


def learn_names(words: DataFrame, statistics: np.ndarray, sure: float = 0.9, share: float = 0.1) -> np.ndarray:
    """The statistics with a gazetteer learned from words_of_names: bit 16 given, bit 32 family names. A word is learned where
    at least a share of the spans that have it there are surely names: a product or firm that follows a cue now and then isn't one."""
    counts = [(r.p, r.n) for r in words.filter("bit = 32").groupBy("p").agg(F.sum("n").alias("n")).orderBy("p").collect()]
    strong = [p for p, q in estimate(counts, seeds=True).items() if q >= sure]

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"k": [int(pdf["k"].iloc[0])], "w": [pdf["w"].to_numpy(np.int32).tobytes()], "bits": [pdf["bits"].to_numpy(np.uint8).tobytes()]})

    met = words.groupBy("w", "bit").agg(F.sum(F.when(F.col("p").isin(strong), F.col("n")).otherwise(0)).alias("strong"), F.sum("n").alias("n"))
    met = met.filter((F.col("strong") > 0) & (F.col("strong") >= share * F.col("n"))).groupBy("w").agg(F.bit_or("bit").alias("bits")).withColumn("k", F.expr("w div 65536"))
    out = statistics.copy()
    for r in met.groupBy("k").applyInPandas(pack, "k bigint, w binary, bits binary").collect():
        out[np.frombuffer(r.w, np.int32)] |= np.frombuffer(r.bits, np.uint8)
    return out


def patterns(proposed: DataFrame) -> list[tuple[str, int]]:
    """Vote patterns and their counts over all spans; at most 3^8 per kind."""
    one = proposed.select(F.explode(F.split("spans", LINE)).alias("s")).select(F.get(F.split("s", UNIT), F.lit(3)).alias("p"))
    return [(r.p, r.n) for r in one.groupBy("p").agg(F.count("*").alias("n")).orderBy("p").collect()]


def _kind(pattern: str) -> str:
    return pattern.rstrip("+-0")


def estimate(counts: list[tuple[str, int]], rounds: int = 60, prior: float = 0.05, seeds: bool = False) -> dict[str, float]:
    """Expectation-maximisation: the posterior of each pattern, from labelers independent given the truth. prior: the
    weight, as a share of the spans, of the belief that a vote is right more often than wrong. Patterns that no labeler speaks
    for are held to be false; they anchor what false means, else a corpus full of headings can settle with every span true.
    seeds: so are names that neither an address nor a cue before them speaks for, for headings and firms recombine as names do."""
    out = {}
    for kind in KINDS:
        mine = [(p, n) for p, n in counts if _kind(p) == kind]
        if not mine:
            continue
        votes = np.array([["-0+".index(c) for c in p[len(kind) :]] for p, _ in mine])
        n = np.array([c for _, c in mine], float)
        score = votes.sum(1) - votes.shape[1]
        held = np.array(["+" not in (p[len(kind) + 3 : len(kind) + 5] if seeds else p[len(kind) :]) for p, _ in mine])
        q = np.where(held, 0.0, 1 / (1 + np.exp(-1.5 * score)))
        w = prior * n.sum()
        belief = np.array([[0.05, 0.35, 0.6], [0.5, 0.4, 0.1]])  # of votes -, 0, + for true and for false spans
        for _ in range(rounds):
            share = (q @ n + 1) / (n.sum() + 2)
            logs = np.log(np.stack([np.full(len(n), share), np.full(len(n), 1 - share)]))
            for k in range(votes.shape[1]):
                for s, mass in enumerate((q * n, (1 - q) * n)):
                    c = np.array([mass[votes[:, k] == v].sum() for v in range(3)]) + w * belief[s]
                    logs[s] += np.log(c / c.sum())[votes[:, k]]
            q = np.where(held, 0.0, 1 / (1 + np.exp(np.clip(logs[1] - logs[0], -50, 50))))
        out |= {p: float(x) for (p, _), x in zip(mine, q, strict=True)}
    return out


def features(pattern: str, kind: str, context: str, text: str) -> list[int]:
    """Places of a span's features that are on: votes, and hashed words around and shape. Spans of one kind have equally many."""
    votes = pattern[len(kind) :]
    out = [0] + [1 + 3 * i + "-0+".index(c) for i, c in enumerate(votes)]
    before, _, after = context.partition("\x1d")
    shape = "".join(dict.fromkeys("A" if c.isupper() else "a" if c.islower() else "9" if c.isdigit() else c for c in text))
    for tag, w in (("b", before), ("a", after), ("s", shape)):
        out.append(1 + 3 * len(votes) + zlib.crc32(f"{tag}{w}".encode()) % HASHED)
    return out


def train(spans_of: list[tuple[str, str, str]], soft: dict[str, float], steps: int = 300, l2: float = 2e-4) -> dict[str, np.ndarray]:
    """The span classifier: one logistic model per kind over votes and contexts, fitted to the posteriors of (pattern, context, text); its weights."""
    out = {}
    for kind in KINDS:
        mine = [(p, c, t) for p, c, t in spans_of if _kind(p) == kind and p in soft]
        if not mine:
            continue
        x = np.array([features(p, kind, c, t) for p, c, t in mine], np.int64)
        y = np.array([soft[p] for p, _, _ in mine])
        w = np.zeros(int(x.max()) + 1 + HASHED)
        moment = np.zeros_like(w)
        # votes carry most; the context is damped, so that it decides where votes leave a span near one half
        scale = np.where(np.arange(x.shape[1]) < x.shape[1] - 3, 1.0, 0.5)
        for _ in range(steps):
            z = np.clip((w[x] * scale).sum(1), -30, 30)
            g = np.bincount(x.ravel(), weights=((1 / (1 + np.exp(-z)) - y)[:, None] * scale).ravel(), minlength=len(w)) / len(y) + l2 * w
            moment += g * g
            w -= 0.5 * g / (np.sqrt(moment) + 1e-6)
        out[kind] = w
    return out


def score(weights: dict[str, np.ndarray], kind: str, pattern: str, context: str, text: str) -> float:
    """The classifier's belief in one span."""
    if kind not in weights:
        return 0.0
    x = features(pattern, kind, context, text)
    w = weights[kind]
    z = float(w[x[:-3]].sum() + 0.5 * sum(w[i] for i in x[-3:] if i < len(w)))
    return 1 / (1 + np.exp(-min(30.0, max(-30.0, z))))


def reachable(weights: dict[str, np.ndarray], kind: str, pattern: str, least: float) -> bool:
    """Whether any context can lift spans of a vote pattern to `least`."""
    if kind not in weights:
        return False
    x = features(pattern, kind, "\x1d", "")
    w = weights[kind]
    best = max(0.0, float(w[1 + 3 * (len(x) - 4) :].max(initial=0.0)))
    return float(w[x[:-3]].sum()) + 1.5 * best >= np.log(least / (1 - least))


def choose(line: str, weights: dict[str, np.ndarray], known: dict, least: float = 0.5) -> list[tuple[str, int, int, str]]:
    """The spans of one document that the classifier accepts, overlaps resolved. known: a worker's memory of the vote patterns that can be accepted."""
    got = []
    for s in line.split(LINE):
        kind, a, b, p, c, t = s.split(UNIT, 5)
        if p not in known:
            known[p] = reachable(weights, kind, p, least)
        # most spans are out by their votes, whatever words are around them
        if known[p] and (x := score(weights, kind, p, c, t)) >= least:
            got.append((-round(x, 3), int(a) - int(b), int(a), int(b), kind, t))
    taken: list[tuple[int, int]] = []
    out = []
    for _, _, a, b, kind, t in sorted(got):
        if all(b <= x or a >= y for x, y in taken):
            taken.append((a, b))
            out.append((kind, a, b, t))
    return sorted(out, key=lambda x: x[1])


class Model:
    """What the corpus taught: statistics of words, the classifier's weights, the posteriors and counts of vote patterns."""

    def __init__(self, docs: DataFrame):
        scratch = Scratch(docs.sparkSession, "pii")
        proposed = scratch.keep(propose(docs), "proposed")
        context = docs.sparkSession.sparkContext
        statistics = word_statistics(docs, proposed)
        # first round: words that recombine, where an address or a cue speaks for them, too; second: the names learned from it
        words = scratch.keep(words_of_names(proposed, context.broadcast(statistics)), "words")
        self.statistics = context.broadcast(learn_names(words, statistics))
        self.spans = scratch.keep(settled(proposed, self.statistics), "spans")
        self.counts = patterns(self.spans)
        self.soft = estimate(self.counts)
        one = self.spans.select(F.explode(F.split("spans", LINE)).alias("s")).select(*[F.get(F.split("s", UNIT), F.lit(i)).alias(n) for i, n in ((3, "p"), (4, "c"), (5, "t"))], F.xxhash64("s", F.monotonically_increasing_id()).alias("h"))
        drawn = one.orderBy("h").limit(TRAINING).collect()
        self.weights = train([(r.p, r.c, r.t) for r in drawn], self.soft)


def details(docs: DataFrame) -> DataFrame:
    """(doc_id, pii_kind, pii_text): every distinct personal detail of each document, as written."""
    model = Model(docs)
    weights = model.weights

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict = {}
        for pdf in batches:
            rows = [(d, k, t) for d, s in zip(pdf["doc_id"], pdf["spans"], strict=True) for k, t in dict.fromkeys((k, t) for k, _, _, t in choose(s, weights, known))]
            yield pd.DataFrame(rows, columns=["doc_id", "pii_kind", "pii_text"])

    return model.spans.mapInPandas(run, "doc_id bigint, pii_kind string, pii_text string").distinct()


def redacted(docs: DataFrame) -> DataFrame:
    """(doc_id, text): every text with its details replaced by typed placeholders such as [EMAIL]. Each row is read once
    more and redacted by the spans of its own text; no text is shuffled."""
    model = Model(docs)
    weights, statistics = model.weights, model.statistics

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict = {}
        for pdf in batches:
            out = []
            for t in pdf["text"]:
                if isinstance(t, str) and t.strip():
                    got = [(k, a, b, settle(v, t[a:b], statistics.value) if k == "person_name" else v, c) for k, a, b, v, c in spans(t)]
                    if got:
                        for k, a, b, _ in reversed(choose(packed([got], [t])[0], weights, known)):
                            t = f"{t[:a]}[{k.upper()}]{t[b:]}"
                out.append(t)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "text": out})

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id bigint, text string")
