"""Personal data: surrogate generation.

Detected entities (e-mail and IP addresses, phone, card, account and social
security numbers, secrets, personal names) are replaced by keyed surrogates
of the same type and format: digits stay digits and separators stay, letters
keep their case and script, a valid card number stays valid, given names keep
their gender. The same entity gets the same surrogate everywhere
(coreference). All distinct entities are checked against each other and
against the real values: whoever clashes gets the next surrogate until every
entity has its own (distinctness).
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, small_batches, written

KEY = b"replace with a secret key of your own"
WIDER_FROM = 3             # attempts from which the space of surrogates grows with each one
MAX_BROADCAST = 50_000     # entities with a later surrogate that are sent to all tasks; more are joined

# Titles by the gender of the given name after them, common
# given names by gender, and syllables of made-up names by script.
TITLES = {"m": "Mr Sir Herr Monsieur Señor Sr Don Господин Κύριος",
          "f": "Mrs Ms Miss Madam Frau Madame Mme Mlle Señora Sra Doña Госпожа Κυρία",
          "n": "Dr Prof Доктор"}
GIVEN = {"m": "James John Robert Michael William David Peter Paul Thomas Hans Karl Jürgen Pierre Jean Louis José "
              "Juan Carlos Pedro Иван Сергей Алексей Γιώργος Νίκος",
         "f": "Mary Patricia Jennifer Linda Elizabeth Susan Anna Maria Laura Heike Ursula Sabine Marie Sophie "
              "Camille Carmen Lucía Isabel Ольга Анна Елена Μαρία Ελένη"}
SYLLABLES = {
    "LATIN": ("ba be bi bo da de di do fa fe ga ge ka ke ki ko la le li lo ma me mi mo na ne ni no "
              "ra re ri ro sa se ta te ti to va ve".split(), "n r s l".split(), "a ia ina".split()),
    "CYRILLIC": ("ба бе во да де ди ка ке ла ле ма ми на не но ра ри са та ти".split(),
                 "н р с в".split(), "а ия ина".split()),
    "GREEK": ("βα γε δα κα κο λα λε μα μι να νε ρα ρι σα τα τε".split(), "ς ος ης".split(), "α η ια".split()),
}

_WORD = r"[^\W\d_][^\W\d_'’-]*"
_TITLED = "|".join(re.escape(t) for g in TITLES.values() for t in g.split())
_GIVEN = "|".join(re.escape(n) for g in GIVEN.values() for n in g.split())
_TITLE_GENDER = {t: g for g, ts in TITLES.items() for t in ts.split()}
_GIVEN_GENDER = {n: g for g, ns in GIVEN.items() for n in ns.split()}
PATTERNS = (
    ("email", re.compile(r"[\w.%+-]+@[\w-]+(?:\.[\w-]+)+")),
    ("secret", re.compile(r"(?i)(?:(?<=token = \")|(?<=token: )|(?<=secret = \")|(?<=password = \")|(?<=api_key = \"))"
                          r"[^\s\"]{8,}|\b(?:AKIA[0-9A-Z]{16}|ghp_\w{36}|sk-\w{20,})\b|(?<!\w)[0-9a-fA-F]{32,}(?!\w)")),
    ("iban", re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")),
    ("ip", re.compile(r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d.]*\d)|(?<![\w:])(?:[0-9a-fA-F]{1,4}:){7}[0-9a-fA-F]{1,4}"
                      r"(?![\w:])|(?<![\w:])(?:[0-9a-fA-F]{1,4}(?::[0-9a-fA-F]{1,4}){0,6})?::"
                      r"(?:[0-9a-fA-F]{1,4}(?::[0-9a-fA-F]{1,4}){0,6})?(?![\w:]|\.\d)")),
    ("phone", re.compile(r"(?<![\d(+])(?:\+\d{1,3}[ .-]?\(?\d{1,4}\)?(?:[ .-]?\d{2,4}){2,4}"
                         r"|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?!\d)")),
    ("ssn", re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])")),
    ("card", re.compile(r"(?<!\d)\d(?:[ -]?\d){12,18}(?!\d)")),
)
_NAMED = re.compile(rf"(?<!\w)(?:(?P<title>{_TITLED})\.? (?P<one>{_WORD})(?: (?P<two>{_WORD}))?"
                    rf"|(?P<given>{_GIVEN}) (?P<last>{_WORD}))(?!\w)")
# Every match holds one of these (an address or a secret may be of letters alone). Fixed strings are searched for as
# such, and the alternatives of a name begin with its letter, so that the engine goes from one such letter to the next.
_DIGIT_OR_AT = re.compile(r"[@\d]")
_SHORT_GROUP = re.compile(r":[a-fA-F]{1,4}:")
_EIGHT_HEX = re.compile(r"[a-fA-F]{8}")
_STARTS: dict[str, list[str]] = {}
for _n in sorted({*_TITLE_GENDER, *_GIVEN_GENDER}):
    _STARTS.setdefault(_n[0], []).append(re.escape(_n[1:]))
_SOME_NAME = re.compile("|".join(rf"{c}(?<!\w{c})(?:{'|'.join(rest)})(?!\w)" for c, rest in _STARTS.items()))
# In lower case; other forms of ``i`` and ``s`` that case-blind patterns take for them included.
_SECRET_SIGNS = ("oken: ", "ghp_", "sk-", "ſk-", "akia", "akıa", "aki̇a")


class _Maybe:
    """In the place of a pattern that looks for any of these."""

    @staticmethod
    def search(text: str) -> bool:
        """Whether the text can hold an entity: true of all texts that do, and of some others."""
        if _DIGIT_OR_AT.search(text) or "::" in text or ' = "' in text or _SHORT_GROUP.search(text):
            return True
        low = text.lower()
        return (any(s in low for s in _SECRET_SIGNS) or _SOME_NAME.search(text) is not None
                # 32 hexadecimal letters in a row hold eight that are four apart.
                or _EIGHT_HEX.search(text[::4]) is not None)


_MAYBE = _Maybe()


def normal(kind: str, value: str) -> str:
    """What the same entity has in common: case and separators do not count."""
    if kind in ("card", "phone", "ssn"):
        return re.sub(r"\D", "", value)
    if kind == "iban":
        return value.replace(" ", "")
    return value.lower()


def _abbreviated(value: str) -> bool:
    """Whether it is an IPv6 address with ``::``, and not a name of code as ``a::b`` (two groups without a digit)."""
    groups = [g for g in value.split(":") if g]
    return 0 < len(groups) < 8 and value.count("::") == 1 and (len(groups) > 2 or any(c.isdigit() for c in value))


def detect(text: str | None) -> list[tuple[int, int, str, str]]:
    """``(start, end, kind, value)``, in order and without overlaps; the kinds
    of names are ``given:m``, ``given:f``, ``given:n`` and ``surname``."""
    if not text or not _MAYBE.search(text):
        return []
    found: list[tuple[int, int, str, str]] = []
    for kind, pattern in PATTERNS:
        if kind == "email" and "@" not in text:
            continue
        for m in pattern.finditer(text):
            value = m.group().rstrip(".-") if kind == "email" else m.group()
            if kind == "ip" and "." in value and any(int(x) > 255 for x in value.split(".")):
                continue
            if kind == "ip" and "::" in value and not _abbreviated(value):
                continue
            found.append((m.start(), m.start() + len(value), kind, value))
    found.extend(_names(text))
    found.sort(key=lambda x: (x[0], -x[1]))
    out: list[tuple[int, int, str, str]] = []
    for f in found:
        if not out or f[0] >= out[-1][1]:
            out.append(f)
    return out


def _names(text: str) -> Iterator[tuple[int, int, str, str]]:
    gender: dict[str, str] = {}      # parts of names in this text, for later mentions by one part
    for m in _NAMED.finditer(text):
        parts = [g for g in ("one", "two", "given", "last") if m.group(g) and m.group(g)[0].isupper()]
        if m.group("title"):
            if "one" not in parts:
                continue
            sex = _TITLE_GENDER[m.group("title")]
            kinds = (f"given:{sex if sex != 'n' else _GIVEN_GENDER.get(m.group('one'), 'n')}", "surname")
            kinds = kinds if "two" in parts else ("surname",)
        elif "last" in parts:
            kinds = (f"given:{_GIVEN_GENDER[m.group('given')]}", "surname")
        else:
            continue
        for g, kind in zip(parts, kinds, strict=False):
            gender.setdefault(m.group(g), kind)
    if gender:
        for m in re.finditer(rf"(?<!\w)(?:{'|'.join(map(re.escape, sorted(gender)))})(?!\w)", text):
            yield m.start(), m.end(), gender[m.group()], m.group()


def _stream(key: bytes, kind: str, value: str, attempt: int) -> Iterator[int]:
    block = 0
    while True:
        yield from hmac.digest(key, f"{kind}\0{value}\0{attempt}\0{block}".encode("utf-8", "surrogatepass"),
                               hashlib.sha256)
        block += 1


def _pick(random: Iterator[int], n: int) -> int:
    """A number below ``n`` (at most 65536), by rejection."""
    while True:
        x = next(random) << 8 | next(random)
        if x < 65536 - 65536 % n:
            return x % n


def _script(c: str) -> str:
    return unicodedata.name(c, "LATIN").split()[0]


def _alike(c: str, random: Iterator[int]) -> str:
    """A random character of the same kind: digit, or letter of the same case and script."""
    if c.isdigit():
        return str(_pick(random, 10))
    if c.isalpha():
        low, high = {"CYRILLIC": (0x430, 32), "GREEK": (0x3B1, 17)}.get(_script(c), (0x61, 26))
        new = chr(low + _pick(random, high))
        return new.upper() if c.isupper() else new
    return c


def luhn(digits: str) -> bool:
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
               for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def surrogate(kind: str, value: str, attempt: int = 0, key: bytes = KEY) -> str:
    """The surrogate of a normalised value.

    The space widens with the attempt, so that any number of entities find
    their own: a syllable, letter or digit more each time, the other private
    addresses, then all.
    """
    wider = max(0, attempt + 1 - WIDER_FROM)
    random = _stream(key, kind.split(":")[0] if kind == "surname" else kind, value, attempt)
    if kind.startswith("given") or kind == "surname":
        script = _script(value[0])
        middle, male, female = SYLLABLES.get(script, SYLLABLES["LATIN"])
        stem = "".join(middle[_pick(random, len(middle))] for _ in range(2 + _pick(random, 2) + wider))
        ends = {"given:m": male, "given:f": female}.get(kind, male + [""])
        return stem + ends[_pick(random, len(ends))]
    if kind == "email":
        local, _, domain = value.partition("@")
        head, dot, top = domain.rpartition(".")
        return "".join(_alike(c, random) for c in local + "a" * wider) + "@" + "".join(_alike(c, random) for c in head) + dot + top
    if kind == "ip" and "::" in value and wider:      # the groups left out as well
        value = ":".join(["0000"] * 8)
    if kind == "ip" and "." in value:
        first = value.split(".")
        if wider > 6:        # all of IPv4 may be taken
            return ":".join(["fd00"] + [f"{_pick(random, 65536):x}" for _ in range(7)])
        if wider and first[:2] == ["192", "168"]:
            first = ["10"]
        if wider > 3:
            first = [""]
        keep = 2 if first[:2] == ["192", "168"] else 1 if first[0] in ("10", "127") else 0
        fresh = [str(1 + _pick(random, 223) if i == 0 else _pick(random, 256)) for i in range(keep, 4)]
        return ".".join(first[:keep] + fresh)
    if kind == "phone":
        keep = 1 if len(value) == 11 else max(0, len(value) - 10)     # the country's digits
        return value[:keep] + "".join(_alike(c, random) for c in value[keep:] + "0" * wider)
    if kind == "iban":
        return value[:2] + "".join(_alike(c, random) for c in value[2:])
    if kind == "secret" and wider and re.fullmatch(r"[0-9a-f]+", value):
        value += "0" * wider
    if kind == "ip" or (kind == "secret" and re.fullmatch(r"[0-9a-f]+", value)):
        return "".join("0123456789abcdef"[_pick(random, 16)] if c != ":" else c for c in value)
    new = "".join(_alike(c, random) for c in value + {"ssn": "0", "secret": "a"}.get(kind, "") * wider)
    if kind == "card" and luhn(value):
        new = next(x for d in range(10) if luhn(x := new[:-1] + str(d)))
    return new


def shaped(mention: str, new: str, kind: str) -> str:
    """The surrogate as the mention is written: its separators and its case."""
    if kind in ("card", "phone", "ssn", "iban"):
        chars = iter(new)
        return "".join(next(chars, "") if c.isalnum() else c for c in mention) + "".join(chars)
    if mention.isupper():
        return new.upper()
    if kind.startswith("given") or kind == "surname":
        return new[:1].upper() + new[1:]
    if len(mention) == len(new):
        return "".join(n.upper() if m.isupper() else n for m, n in zip(mention, new, strict=True))
    return new


def replace(text: str | None, attempts: Callable[[tuple[str, str]], int], key: bytes = KEY,
            make: Callable[..., str] = surrogate) -> tuple[str | None, int]:
    """The text with its entities replaced, and how many there were."""
    found = detect(text)
    if not found:
        return text, 0
    out, at = [], 0
    for start, end, kind, value in found:
        norm = normal(kind, value)
        out += [text[at:start], shaped(value, make(kind, norm, attempts((kind, norm)), key), kind)]
        at = end
    return "".join(out) + text[at:], len(found)


def _fresh(entities: DataFrame, key: bytes, make: Callable[..., str]) -> DataFrame:
    @F.pandas_udf("string")
    def new(kind: pd.Series, value: pd.Series, attempt: pd.Series) -> pd.Series:
        return pd.Series([make(k, v, int(a), key) for k, v, a in zip(kind, value, attempt, strict=True)])
    return entities.withColumn("new", new("kind", "value", "attempt"))


def later_attempts(docs: DataFrame, key: bytes = KEY, text_col: str = "text",
                   make: Callable[..., str] = surrogate) -> DataFrame:
    """``kind, value, attempt`` of the entities whose first surrogate was taken.

    All distinct entities of the table are compared: a surrogate must differ
    from every other entity's surrogate and from every real value. Of those
    that share one the first by value keeps it.
    """
    def run(batches):
        for b in batches:
            pairs = {(k, normal(k, v)) for t in b["text"] for _, _, k, v in detect(t)}
            yield {"kind": [k for k, _ in pairs], "value": [v for _, v in pairs]}

    real = written(map_batches(docs.select(F.col(f"`{text_col}`").alias("text")), run, "kind string, value string")
                   .distinct().withColumn("attempt", F.lit(0)), "pii-entities")
    # Given names of either gender share one space of surrogates, as do surnames.
    space = F.split(F.col("kind"), ":")[0]
    everyone = _fresh(real, key, make).withColumn("space", space)
    taken = real.select(space.alias("space"), F.col("value").alias("new")).distinct().withColumn("real", F.lit(True))
    moved = None
    while True:
        least = everyone.groupBy("space", "new").agg(F.min(F.struct("kind", "value")).alias("first"),
                                                     F.count("*").alias("n"))
        clash = (everyone.join(least, ["space", "new"]).join(taken, ["space", "new"], "left")
                 .where(F.col("real") | ((F.col("n") > 1) & (F.struct("kind", "value") != F.col("first")))))
        again = written(clash.select("kind", "value", (F.col("attempt") + 1).alias("attempt")), "pii-clashes")
        if again.isEmpty():
            break
        moved = again if moved is None else moved.join(again, ["kind", "value"], "left_anti").unionByName(again)
        moved = written(moved, "pii-moved")
        everyone = _fresh(real.drop("attempt").join(moved, ["kind", "value"], "left")
                          .fillna(0, ["attempt"]), key, make).withColumn("space", space)
    return moved if moved is not None else real.limit(0)


def with_surrogates(docs: DataFrame, key: bytes = KEY, text_col: str = "text",
                    max_broadcast: int = MAX_BROADCAST, make: Callable[..., str] = surrogate) -> DataFrame:
    """``docs`` with the text replaced and a last column ``n_entities``.

    All columns are kept (an input column ``n_entities`` is replaced). Null
    and empty texts stay as they are, with 0 entities. Repeated rows get equal
    texts. Empty table: no rows. Entities that need a later surrogate are few
    and sent to all tasks up to ``max_broadcast``; beyond it each text gets
    its own by a join on its hash.
    """
    spark = docs.sparkSession
    small_batches(spark)
    moved = later_attempts(docs, key, text_col, make)
    few = moved.limit(max_broadcast + 1).collect()
    # The input goes along as one column, so that no name in it can clash.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col(f"`{text_col}`").alias("text"))
    text = F.col("text")

    if len(few) <= max_broadcast:
        shared = spark.sparkContext.broadcast({(r.kind, r.value): r.attempt for r in few})

        @F.pandas_udf("text string, n_entities int")
        def changed(texts: pd.Series) -> pd.DataFrame:
            later = shared.value
            return pd.DataFrame([replace(t, lambda e: later.get(e, 0), key, make) for t in texts],
                                columns=["text", "n_entities"])

        out, made = rows, changed(text)
    else:
        def mentions(batches):
            for b in batches:
                rows = {(h, k, normal(k, v)) for h, t in zip(b["hash"], b["text"], strict=True)
                        for _, _, k, v in detect(t)}
                yield {"hash": [r[0] for r in rows], "kind": [r[1] for r in rows], "value": [r[2] for r in rows]}

        own = (map_batches(rows.select(F.xxhash64(text).alias("hash"), "text"), mentions,
                           "hash long, kind string, value string").distinct()
               .join(moved, ["kind", "value"]).groupBy("hash")
               .agg(F.collect_list(F.struct("kind", "value", "attempt")).alias("later")))

        @F.pandas_udf("text string, n_entities int")
        def changed_by(texts: pd.Series, later: pd.Series) -> pd.DataFrame:
            rows = []
            for t, own_later in zip(texts, later, strict=True):
                known = {(e["kind"], e["value"]): e["attempt"] for e in (own_later if own_later is not None else [])}
                rows.append(replace(t, lambda e, known=known: known.get(e, 0), key, make))
            return pd.DataFrame(rows, columns=["text", "n_entities"])

        out = rows.join(own, F.xxhash64(text) == F.col("hash"), "left")
        made = changed_by(text, F.col("later"))
    out = out.select("row", "text", made.alias("made"))
    return out.select(*[(F.when(text.isNull(), F.lit(None)).otherwise(F.col("made.text")) if c == text_col
                         else F.col(f"row.`{c}`")).alias(c) for c in docs.columns if c != "n_entities"],
                      F.col("made.n_entities").alias("n_entities"))
