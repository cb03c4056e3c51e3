"""Personal data replaced by surrogates.

Entities are found by patterns and replaced by values of the same kind and format, made from a
secret key: one entity has one surrogate throughout the corpus (coreference), and two entities
have two (distinctness). A surrogate follows the script, the case and the punctuation of what it
replaces, names the gender too; card numbers keep their check digit valid. A person is found
after a title, and then wherever the document has one of the names by itself. Distinctness is
checked over the whole corpus: of entities that share a surrogate all but the smallest, and any
whose surrogate is itself an entity that occurs, are given their next one, until none is left.
"""

from __future__ import annotations

import bisect
import hashlib
import re
import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.words import documents, per_batch, store

#: Entities with a later surrogate than their first that are sent to the tasks by value.
MOST_BY_VALUE = 100_000

#: Fixed lists: titles by the gender of the person named after them.
TITLES = {
    "m": "Mr Herr Monsieur Señor Sr Don Sir Lord Господин Г-н Κύριος Κος".split(),
    "f": "Mrs Ms Miss Frau Madame Mme Mademoiselle Señora Sra Doña Lady Госпожа Г-жа Κυρία Κα".split(),
    "n": "Dr Prof Professor Доктор".split(),
}
_GENDER = {t: g for g, titles in TITLES.items() for t in titles}
_NAME = r"[^\W\d_a-zа-яα-ω][^\W\d_]+(?:[-'’][^\W\d_]+)*"
#: Between two digits of an international number.
_GAP = r"(?:[ \t\xa0]?[-‐-―/()]{1,2}[ \t\xa0]?|[ \t\xa0.]?)"
_PATTERNS = {
    "email": r"[\w.+-]*\w@\w[\w-]*(?:\.\w[\w-]*)+",
    "secret": r"(?i:(?:token|secret|passw(?:or)?d|api[_-]?key|access[_-]?key)[\"']?\s*[=:]\s*[\"']?)(?P<held>[\w+/=-]{8,})|(?<!\w)(?:[0-9a-fA-F]{32,}|AKIA[0-9A-Z]{16}|gh[pousr]_\w{20,}|sk-\w{20,})(?!\w)",
    "iban": r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    "ip": r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    # With country code 1 ten digits more; others of 7 to 15 digits in any groups.
    "phone": r"(?<![\w+])\+(?:1(?:" + _GAP + r"\d){10}|(?!1" + _GAP + r"(?:\d" + _GAP + r"){9}\d(?!\w))\(?\d(?:" + _GAP + r"\d){6,14})(?!\w)|(?<![\w+])(?:\+\d{1,3}[^\w\n]{1,5})\(?\d{2,4}[^\w\n]{1,5}\d{3,4}[^\w\n]{1,4}\d{3,4}(?!\w)|(?<!\w)\+\d{9,14}(?!\w)|(?<!\w)\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4}(?!\w)",
    "card": r"(?<!\w)(?:\d{4}[ -]?){3}\d{1,7}(?!\w)|(?<!\w)\d{13,19}(?!\w)",
    "name": r"(?<!\w)(?P<title>" + "|".join(sorted(map(re.escape, _GENDER), key=len, reverse=True)) + r")\.?[ \t]+(?P<named>" + _NAME + r"(?:[ \t]+" + _NAME + r"){0,2})",
}
_ENTITY = re.compile("|".join(f"(?P<{kind}>{pattern})" for kind, pattern in _PATTERNS.items()))
#: What no entity can do without: looked for first, since most texts have nothing.
_HINT = re.compile(r"[0-9@]|(?<!\w)(?:" + "|".join(map(re.escape, _GENDER)) + r")\b|AKIA|gh[pousr]_|sk-|(?i:token|secret|passw|key)")

#: Letters of surrogates by script, consonants and vowels.
_LETTERS = {"LATIN": ("bdfgklmnprstvz", "aeiou"), "CYRILLIC": ("бвгдзклмнпрст", "аеиоу"), "GREEK": ("βγδκλμνπρστ", "αειου")}
#: Country codes of two digits; those of one are 1 and 7, all others have three.
_TWO_DIGIT_CODES = frozenset("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
#: Endings of given names by gender; all begin with a letter that no other gender ends on.
_ENDINGS = {"LATIN": {"f": "a", "m": "n", "n": "e"}, "CYRILLIC": {"f": "а", "m": "н", "n": "и"}, "GREEK": {"f": "α", "m": "ς", "n": "ι"}}


def entities(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, value) in order; a person's given names and surname are one each."""
    if not _HINT.search(text):
        return []
    out, titled = [], {}
    for m in _ENTITY.finditer(text):
        kind = next(k for k in _PATTERNS if m[k] is not None)
        if kind == "name":
            parts = list(re.finditer(r"[^ \t]+", m["named"]))
            gender, base = _GENDER[m["title"]], m.start("named")
            for i, part in enumerate(parts):
                name = re.sub(r"['’]s$", "", part[0])
                # A surname is the same for all of a family where its form does not differ.
                sort = f"given_{gender}" if i < len(parts) - 1 else "surname"
                out.append((base + part.start(), base + part.start() + len(name), sort, name))
                titled.setdefault(name.casefold(), {})[sort] = name
        else:
            span = m.span("held") if m["held"] is not None else m.span()
            out.append((*span, kind, text[span[0] : span[1]]))
    return _with_mentions(text, out, titled) if titled else out


def _with_mentions(text: str, found: list[tuple[int, int, str, str]], titled: dict[str, dict[str, str]]) -> list[tuple[int, int, str, str]]:
    """``found`` and what else in the text is a name of a person found after a title, by
    folded name the sorts that it has. Written with a capital, or in capitals."""
    forms = {form: sorts for sorts in titled.values() for name in sorts.values() for form in (name, name.upper(), name.title())}
    pattern = re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, sorted(forms, key=len, reverse=True))) + r")(?!\w)")
    starts, more = [f[0] for f in found], []
    for m in pattern.finditer(text):
        i = bisect.bisect_left(starts, m.end()) - 1
        if i < 0 or found[i][1] <= m.start():
            more.append(m)
    follows = {b.start(): b for b in more}
    for m in more:
        sorts = forms[m[0]]
        given = sorted((x for x in sorts if x != "surname"), key=lambda x: x == "given_n")
        gap = re.compile(r"[ \t]+").match(text, m.end())
        after = follows.get(gap.end()) if gap else None
        first = given and (len(given) == len(sorts) or after is not None and "surname" in forms[after[0]])
        found.append((*m.span(), given[0] if first else "surname", m[0]))
    return sorted(found)


def canonical(kind: str, value: str) -> str:
    """What is one entity however it is written: digits of numbers, lower-cased letters."""
    if kind in ("phone", "card", "ssn"):
        return "+" * (kind == "phone" and value[0] == "+") + re.sub(r"\D", "", value)
    return value if kind == "secret" else re.sub(r"\s", "", value).casefold()


#: Attempts that keep the size of an entity.
SAME_SIZE = 4


class _Stream:
    """Pseudo-random numbers of one entity, from the key."""

    def __init__(self, key: bytes, *parts: object) -> None:
        self.seed, self.turn, self.pool = "\x1f".join(map(str, parts)).encode("utf-8", "surrogatepass"), 0, b""
        self.key = hashlib.sha256(key).digest()

    def below(self, n: int) -> int:
        if len(self.pool) < 4:
            self.pool += hashlib.blake2b(self.turn.to_bytes(4, "big") + self.seed, key=self.key, digest_size=64).digest()
            self.turn += 1
        value, self.pool = int.from_bytes(self.pool[:4], "big"), self.pool[4:]
        return value % n

    def of(self, items: str) -> str:
        return items[self.below(len(items))]


def _script(char: str) -> str:
    return next((s for s in _LETTERS if unicodedata.name(char, "").startswith(s)), "LATIN")


def _letter(char: str, stream: _Stream, place: int) -> str:
    new = stream.of(_LETTERS[_script(char)][place % 2])
    return new.upper() if char.isupper() else new


def _same_format(value: str, stream: _Stream) -> str:
    """Digits for digits and letters of the same script and case for letters."""
    return "".join(stream.of("0123456789") if c.isdigit() else _letter(c, stream, i) if c.isalpha() else c for i, c in enumerate(value))


def _luhn(digits: str) -> int:
    doubled = [int(d) * 2 if i % 2 else int(d) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10


def _refill(value: str, digits: str) -> str:
    """``value`` with these digits in place of its own; what is left over follows."""
    fresh = iter(digits)
    return "".join(next(fresh) if c.isdigit() else c for c in value) + "".join(fresh)


def _octet(part: str, more: int, stream: _Stream) -> str:
    """A number of as many digits as ``part`` and ``more``; up to 254 while there are three."""
    size = len(part) + more
    least, most = (1, 9) if size == 1 else (10 ** (size - 1), 254 if size == 3 else 10**size - 1)
    return str(least + stream.below(most - least + 1)) if size < 9 else str(stream.below(9) + 1) + "".join(stream.of("0123456789") for _ in range(size - 1))


def _country(digits: str) -> int:
    """Digits of the country code that an international number begins with."""
    return 1 if digits[0] in "17" else 2 if digits[:2] in _TWO_DIGIT_CODES else 3


def _cased(made: str, value: str) -> str:
    """Letters in the case of those that they stand for, where the lengths are the same."""
    return "".join(m.upper() if v.isupper() else m for m, v in zip(made, value, strict=True)) if len(made) == len(value) else made


def surrogate(kind: str, value: str, attempt: int, key: bytes) -> str:
    """The replacement of an occurrence. Made from the canonical value, the attempt and the
    key alone, then laid out (spaces, case of a name or an address) as the occurrence is. From
    attempt SAME_SIZE on it is longer by one character more each time, so that there is always
    a free one, even where the corpus holds every value of a format."""
    whole = canonical(kind, value)
    stream = _Stream(key, kind, whole, attempt)
    more = max(0, attempt - SAME_SIZE + 1)
    if kind == "email":
        local, _, domain = whole.partition("@")
        shared = _Stream(key, "domain", domain, 0)  # one domain, one surrogate
        host = _same_format(domain.split(".")[0], shared)
        written, _, at = value.partition("@")
        own = _cased(_same_format(local, stream), written) + "".join(stream.of("abcdefghij") for _ in range(more))
        return f"{own}@{_cased(host, at.split('.')[0])}.example.{'org' if domain.endswith('org') else 'com'}"
    if kind == "ip":
        return ".".join(_octet(part, (more + 3 - i) // 4, stream) for i, part in enumerate(value.split(".")))
    if kind in ("phone", "card", "ssn"):
        old = whole.lstrip("+")
        kept = _country(old) if whole != old else 1 if kind == "card" else 0
        digits = old[:kept] + "".join(stream.of("0123456789") for _ in range(len(old) - kept + more))
        if kind == "card" and (_luhn(whole) == 0) != (_luhn(digits) == 0):
            # The last digit makes the check right; one more makes it wrong.
            last = (int(digits[-1]) - _luhn(digits)) % 10
            digits = digits[:-1] + str(last if _luhn(whole) == 0 else (last + 1) % 10)
        return _refill(value, digits)
    if kind == "secret":
        prefix = re.match(r"AKIA|gh[pousr]_|sk-", value)
        head = prefix[0] if prefix else ""
        rest = value[len(head) :]
        if re.fullmatch("[0-9a-f]+", rest) or re.fullmatch("[0-9A-F]+", rest):
            hexes = "0123456789abcdef" if rest.islower() or rest.isdigit() else "0123456789ABCDEF"
            return head + "".join(stream.of(hexes) for _ in range(len(rest) + more))
        return head + _same_format(rest, stream) + "".join(stream.of("0123456789") for _ in range(more))
    if kind == "iban":
        fresh = iter(whole[:2].upper() + _same_format(whole[2:].upper(), stream) + "".join(stream.of("0123456789") for _ in range(more)))
        return "".join(c if c.isspace() else next(fresh) for c in value) + "".join(fresh)
    # Names: syllables of the same script, about as long, ending by gender.
    script = _script(whole[0])
    gender = kind[-1] if kind != "surname" else "f" if script == "CYRILLIC" and whole[-1] == "а" else "n"
    size = max(4, min(10, len(whole))) + attempt
    letters = "".join(stream.of(_LETTERS[script][i % 2]) for i in range(size - 1))
    if script == "GREEK" and gender == "m":
        letters = letters[:-1] + "ο"
    name = letters + _ENDINGS[script][gender if kind != "surname" or script == "CYRILLIC" else "n"]
    return name.upper() if value.isupper() and len(value) > 1 else name[0].upper() + name[1:]


def _replaced(text: str, later: dict[tuple[str, str], tuple[str, int]], key: bytes) -> tuple[str, int]:
    parts, at, found = [], 0, entities(text)
    for start, end, kind, value in found:
        meant, attempt = later.get((kind, canonical(kind, value)), (kind, 0))
        parts += [text[at:start], surrogate(meant, value, attempt, key)]
        at = end
    return "".join(parts) + text[at:], len(found)


def _meant(seen: DataFrame) -> DataFrame:
    """kind, value, meant: a given name after a title without gender is the one of the gender
    that the corpus has it with, if that is one only."""
    gendered = seen.where(F.col("kind").isin("given_m", "given_f")).groupBy("value").agg(F.min("kind").alias("one"), F.max("kind").alias("other"))
    sure = gendered.where("one = other").select(F.lit("given_n").alias("kind"), "value", "one")
    return seen.join(sure, ["kind", "value"], "left").select("kind", "value", F.coalesce("one", "kind").alias("meant"))


def later_attempts(docs: DataFrame, key: bytes) -> DataFrame:
    """kind, value, meant, attempt of the entities that cannot have the first surrogate of
    their kind: it has to be that of kind ``meant`` and of a later attempt."""

    def find(batch):
        pairs = [sorted({(k, canonical(k, v)) for _, _, k, v in entities(t or "")}) for t in batch.column("text").to_pylist()]
        flat = [p for ps in pairs for p in ps]
        return {"kind": [p[0] for p in flat], "value": [p[1] for p in flat]}

    seen = store(per_batch(docs.select("text"), find, "kind string, value string").distinct(), "seen")
    meant = store(_meant(seen), "meant")
    rows = meant.select(F.col("meant").alias("kind"), "value").distinct()
    table = store(rows.withColumn("attempt", F.lit(0)), "entities")
    # Given names and surnames share one space: none stands for an occurring one of any kind.
    space = F.when(F.col("kind") == "surname", "name").when(F.col("kind").startswith("given_"), "name").otherwise(F.col("kind")).alias("space")
    values = table.select(space, F.col("value").alias("fake")).distinct()

    def make(batch):
        cells = list(zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True))
        fakes = [canonical(k, surrogate(k, value, n, key)) for k, value, n in cells]
        return {name: batch.column(name) for name in ("kind", "value", "attempt")} | {"fake": fakes}

    while True:
        made = store(per_batch(table, make, "kind string, value string, attempt int, fake string"), "surrogates")
        # Of those that share one, the smallest keeps it.
        spaced, who = made.select("*", space), F.struct("value", "kind")
        owners = spaced.groupBy("space", "fake").agg(F.min(who).alias("owner"), F.count("*").alias("n")).where("n > 1").drop("n")
        taken = spaced.join(values, ["space", "fake"], "left_semi").select("kind", "value")
        shared = spaced.join(owners, ["space", "fake"]).where(who != F.col("owner")).select("kind", "value")
        clashes = store(taken.unionByName(shared).distinct().withColumn("again", F.lit(1)), "clashes")
        if not clashes.limit(1).count():
            tried = made.select(F.col("kind").alias("meant"), "value", "attempt")
            return meant.join(tried, ["meant", "value"]).where("attempt > 0 OR meant <> kind").select("kind", "value", "meant", "attempt")
        nexts = made.drop("fake").join(clashes, ["kind", "value"], "left")
        table = store(nexts.select("kind", "value", (F.col("attempt") + F.coalesce("again", F.lit(0))).alias("attempt")), "entities")


def replace_entities(docs: DataFrame, key: bytes) -> DataFrame:
    """doc_id, text with surrogates, n_entities for every row of ``docs``.

    Null texts stay null and have no entity. The same key gives the same surrogates for the
    same corpus. Columns other than doc_id and text are not looked at.
    """
    later = store(later_attempts(docs, key), "later-surrogates")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known: dict[tuple[str, str], int] = {}
    if later.limit(MOST_BY_VALUE + 1).count() <= MOST_BY_VALUE:
        known = {(r.kind, r.value): (r.meant, r.attempt) for r in later.collect()}
        rows = rows.withColumn("later", F.array().cast("array<struct<kind:string,value:string,meant:string,attempt:int>>"))
    else:
        # Too many to send: each text meets those that it holds.
        def held(batch):
            pairs = [(t, k, canonical(k, v)) for t in batch.column("text").to_pylist() for _, _, k, v in entities(t or "")]
            return {"digest": [hashlib.md5(t.encode("utf-8", "surrogatepass")).hexdigest() for t, _, _ in pairs], "kind": [p[1] for p in pairs], "value": [p[2] for p in pairs]}

        found = per_batch(docs.select("text"), held, "digest string, kind string, value string").distinct()
        lists = found.join(later, ["kind", "value"]).groupBy("digest").agg(F.collect_list(F.struct("kind", "value", "meant", "attempt")).alias("later"))
        rows = rows.withColumn("digest", F.md5("text")).join(lists, "digest", "left").select("doc_id", "text", "later")

    def replace(batch):
        texts, counts = [], []
        for text, own in zip(batch.column("text").to_pylist(), batch.column("later").to_pylist(), strict=True):
            extra = {(x["kind"], x["value"]): (x["meant"], x["attempt"]) for x in own or ()}
            new, n = _replaced(text, extra or known, key) if text else (text, 0)
            texts.append(new)
            counts.append(n)
        return {"doc_id": batch.column("doc_id"), "text": texts, "n_entities": counts}

    return per_batch(rows, replace, "doc_id long, text string, n_entities long")


#: Of the registered query only; a user passes a secret of their own.
DEMO_KEY = b"shelfmark"


def op2_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_entities(documents(spark, sf_dir), DEMO_KEY)
