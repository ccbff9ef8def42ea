"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors: at-signs, schemes (``://``), a plus
sign before a digit, digits around a dot or side by side, and identifier cue
words.  From each anchor a deterministic local parser expands to the bounds of
the value and validates it.  Text without anchors is passed over at the
automaton's speed, and a parser reads only the run of characters that its kind
allows; behind a cue word that is 34 letters and digits and the rest of the last
group, so that texts full of cue words cost in proportion to their length.

Kinds, in the order used for ties: email, ip, card, phone (the base kinds, each
leftmost and non-overlapping), then url (an address with user data before
its at-sign) and account (an identifier after a cue word).  A value that fails
validation is dropped and not tried again from a later character.

Defined cases: null text is empty and has no span; ids and repeated rows are
carried as they are; positions are code points, end exclusive.
"""

from __future__ import annotations

import hashlib
import re

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.llm.common import keyed

KINDS = ("email", "ip", "card", "phone", "url", "account")
BASE = KINDS[:4]
# The grammar of the base kinds as their contract states it.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DIGITS = "0123456789"
# url and account
SCHEME = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+.-")
URL = re.compile(r"://[^\s/@:<>\"']++(?::[^\s/@<>\"']*+)?@[A-Za-z0-9.-]++(?::[0-9]++)?(?:/[^\s<>\"']*+)?")
CUES = ("account", "acct", "iban", "passport", "ssn", "customer id", "member id", "user id")
LEAD = re.compile(r"(?:[ ]?(?:no\.?|number|nr\.?|#))?[ ]?[:=#]?[ ]?([A-Za-z0-9])")
PART = re.compile(r"[A-Za-z0-9]++(?:-[A-Za-z0-9]++)*+")
#: Letters and digits of an identifier.
LEAST_VALUE, MOST_VALUE = 6, 34


def _anchors() -> ahocorasick.Automaton:
    found: dict[str, str] = {"@": "email", "://": "url"}
    found |= {"+" + d: "phone" for d in DIGITS}
    found |= {f"{a}.{b}": "ip" for a in DIGITS for b in DIGITS}
    found |= {f"{a}{s}{b}": "card" for a in DIGITS for b in DIGITS for s in ("", " ", "-")}
    for cue in CUES:
        found |= {c: "account" for c in (cue, cue.upper(), cue.capitalize(), cue.title())}
    out = ahocorasick.Automaton()
    for word, kind in found.items():
        out.add_word(word, (kind, len(word)))
    out.make_automaton()
    return out


ANCHORS = _anchors()


def luhn(digits: str) -> bool:
    odd, even = digits[::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def _back(text: str, at: int, least: int, allowed) -> int:
    """First position of the run of allowed characters that ends before ``at``."""
    while at > least and text[at - 1] in allowed:
        at -= 1
    return at


def _email(text: str, at: int, done: int):
    start = _back(text, at, done, LOCAL)
    domain = DOMAIN.match(text, at + 1) if start < at else None
    return (start, domain.end(), True) if domain else None


def _ip(text: str, at: int, done: int):
    start = _back(text, at, done, DIGITS)
    m = IP.match(text, start)
    if m is None:
        return None
    parts = [p.lstrip("0") for p in m.group().split(".")]
    return start, m.end(), all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)


def _card(text: str, at: int, done: int):
    start = at
    while True:  # back over digits with single separators between them
        start = _back(text, start, done, DIGITS)
        if start - 2 >= done and text[start - 1] in " -" and text[start - 2] in DIGITS:
            start -= 1
        else:
            break
    m = CARD.match(text, start)
    if m is None:
        return None
    digits = m.group().replace(" ", "").replace("-", "")
    return start, m.end(), 14 <= len(digits) <= 19 and luhn(digits)


def _phone(text: str, at: int, done: int):
    m = PHONE.match(text, at)
    if m is None:
        return None
    return at, m.end(), 10 <= sum(map(m.group().count, DIGITS)) <= 15


def _url(text: str, at: int, done: int):
    start = _back(text, at, done, SCHEME)
    m = URL.match(text, at) if start < at else None
    return (start, m.end(), True) if m else None


def _account(text: str, at: int, done: int):
    """``at`` is the cue's end.  Groups after the first count only while they
    have a digit, so that the words behind an identifier stay outside."""
    if at < len(text) and (text[at].isalnum() or text[at] == "_"):
        return None
    m = LEAD.match(text, at)
    if m is None:
        return None
    start = end = m.start(1)
    size = 0
    while size <= MOST_VALUE:  # beyond, no more is read: it isn't an identifier
        part = PART.match(text, start if end == start else end + 1)
        if part is None or not any(map(part.group().__contains__, DIGITS)):
            break
        size += len(part.group()) - part.group().count("-")
        end = part.end()
        if end >= len(text) or text[end] != " ":
            break
    return start, end, LEAST_VALUE <= size <= MOST_VALUE and sum(map(text[start:end].count, DIGITS)) >= 4


PARSERS = {"email": _email, "ip": _ip, "card": _card, "phone": _phone, "url": _url, "account": _account}


def find(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then kind as listed in KINDS."""
    done = dict.fromkeys(KINDS, 0)
    out = []
    for last, (kind, size) in ANCHORS.iter(text):
        at = last + 1 - size if kind != "account" else last + 1
        if kind in ("ip", "card"):
            at = max(at, done[kind])
            if at >= last:
                continue  # the anchor lies in a value that was read already
        elif at < done[kind]:
            continue
        got = PARSERS[kind](text, at, done[kind])
        if got:
            start, end, valid = got
            done[kind] = end
            if valid:
                out.append((start, end, kind))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def written(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def redact(text: str) -> str:
    """Each span, overlapping ones together, becomes its first kind in brackets."""
    out, at = [], 0
    for start, end, kind in find(text):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:] if out else text


REPORT = T.StructType([T.StructField(f"n_{k}", T.LongType()) for k in BASE]
                      + [T.StructField(n, T.StringType()) for n in ("base_sha256", "spans")])


@F.pandas_udf(REPORT)
def _report(texts: pd.Series) -> pd.DataFrame:
    rows = []
    for text in texts:
        spans = find(text)
        base = [s for s in spans if s[2] in BASE]
        kinds = [s[2] for s in base]
        rows.append((*map(kinds.count, BASE), hashlib.sha256(written(base).encode()).hexdigest(), written(spans)))
    return pd.DataFrame(rows, columns=REPORT.names)


@F.pandas_udf(T.StringType())
def _redact(texts: pd.Series) -> pd.Series:
    return texts.map(redact, na_action="ignore")


def personal_data(docs: DataFrame) -> DataFrame:
    """Counts, digest and spans of personal data for every row."""
    return keyed(docs).select("doc_id", _report("text").alias("r")).select("doc_id", "r.*")


def redacted(column: str = "text") -> Column:
    return _redact(F.col(column))


def redact_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data replaced by its kind; same rows and
    columns.  ``n_chars``, where present, follows the text; null text stays null."""
    out = docs.withColumn("text", redacted())
    if "n_chars" in out.columns:
        kind = dict(docs.dtypes)["n_chars"]
        out = out.withColumn("n_chars", F.coalesce(F.char_length("text").cast(kind), F.col("n_chars")))
    return out
