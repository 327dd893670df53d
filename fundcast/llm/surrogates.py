"""Surrogates for personal data: keyed, type-consistent replacements.

Entities are found by pattern: secrets, e-mail and IP addresses, card, account
and social security numbers, phone numbers, and person names after a form of
address or a common given name. Every entity gets a replacement of its type and
format: digits and letters are permuted in place by a keyed Feistel cipher (so
length, case, separators, country codes and valid check digits stay), given names
come from tables of the same script and gender or, if they are in none, are built
from syllables like family names, with an ending of the gender. The replacement depends on the key
and the entity alone, so an entity has the same one in all documents.

Collision checks make that safe: over all distinct entities of the corpus, no
two may share a replacement and none may equal an original; those that do are
drawn again with the next attempt number until none is left. Only documents
that hold such an entity carry overrides.

Edge cases: a null text stays null and holds nothing; an empty text likewise;
repeated rows are replaced alike; overlapping entities go to the earlier
pattern; very long texts are read whole; an empty table gives an empty result;
other columns are left out, except those named in ``keep``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundcast.session import cut_lineage

MAX_ATTEMPTS = 20

# Given names by script and gender, syllables of surnames, forms of address.
GIVEN = {
    ("latin", "f"): "Alice Bianca Carla Daniela Emilia Fiona Gloria Helena Ingrid Julia Katrin Louise Martha Nadine Olivia Paula".split(),
    ("latin", "m"): "Albert Bernard Carlos Dominic Edward Frederic George Hector Ivan Julian Konrad Leonard Martin Nicolas Oscar Patrick".split(),
    ("cyrillic", "f"): "Анна Вера Галина Дарья Елена Жанна Зоя Ирина Ксения Лидия Мария Нина".split(),
    ("cyrillic", "m"): "Антон Борис Виктор Глеб Денис Егор Игорь Кирилл Леонид Максим Никита Олег".split(),
}
#: Endings of given names that are built from syllables; no two genders share one.
ENDINGS = {("latin", "f"): "lia", ("latin", "m"): "rin", ("cyrillic", "f"): "лия", ("cyrillic", "m"): "рин"}
GENDER = {name: gender for (_, gender), names in GIVEN.items() for name in names}
SYLLABLES = {
    "latin": "ba be bi bo bu da de di do du ga ge go ka ke ki ko la le li lo ma me mi mo na ne no pa pe ra re ro sa se so ta te to va ve wa".split(),
    "cyrillic": "ба бе би бо ва ве ви во да де до за зе ка ко ла ле ли ма ме ми мо на не но па по ра ре ро са со та то".split(),
}
FEMALE = "Mrs Ms Miss Madam Frau Madame Mme Señora Sra Signora Г-жа Госпожа".split()
MALE = "Mr Mister Sir Herr Monsieur Señor Signor Г-н Господин".split()
TITLES = "Dr Prof Professor Doctor".split()

_CAP = r"[A-ZÀ-ÖØ-ÞА-ЯЁ][a-zà-öø-ÿа-яё]{1,30}(?:[-'’][A-ZÀ-ÖØ-ÞА-ЯЁ][a-zà-öø-ÿа-яё]{1,30})?"
_KNOWN = "|".join(n for names in GIVEN.values() for n in names if len(n) >= 5)
_FORMS = "|".join(FEMALE + MALE + TITLES)
PATTERNS = {
    "secret": r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{30,}|sk-[A-Za-z0-9_\-]{20,}|xox[abprs]-[A-Za-z0-9\-]{10,}"
    r"|[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![A-Za-z0-9])"
    r"|(?<=[\"'])(?<!\w)[A-Za-z0-9+/_\-]{24,}={0,2}(?=[\"'])",
    "email": r"(?<![\w.%+\-])[\w.%+\-]{1,64}@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)+",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?!\d|\.\d)",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "card": r"(?<![\d.])(?:\d{13,19}|\d{4}(?P<gap>[ \-])\d{4}(?:(?P=gap)\d{4}){1,2}(?:(?P=gap)\d{1,4})?|\d{4}[ \-]\d{6}[ \-]\d{4,5})(?!\d)",
    "ssn": r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])",
    "phone": r"(?<![\w+])\+\d{1,3}(?:[ .\-]?\(?\d{1,5}\)?){2,5}(?!\d)|(?<![\w.])\(?\d{3}\)?[ .\-]\d{3}[ .\-]\d{4}(?!\d)",
    "name": rf"(?<!\w)(?:(?P<form>{_FORMS})\.? (?P<after>{_CAP}(?: {_CAP}){{0,2}})|(?P<given>{_KNOWN}) (?P<family>{_CAP}))(?!\w)",
}
_ALL = re.compile("|".join(f"(?P<{k}>{p})" for k, p in PATTERNS.items()))
#: No pattern matches a text without one of these.
_HINT = re.compile(rf"[0-9@]|(?<!\w)(?:{_FORMS})\.? |(?<!\w)(?:{_KNOWN}) |[\"'][A-Za-z+/_\-]{{24}}"
                   r"|(?<![A-Za-z0-9])(?:AKIA|gh[pousr]_|sk-|xox[abprs]-|[a-f]{32}|[A-F]{32})")


def _number(key: bytes, *parts) -> int:
    data = "\x1f".join(map(str, parts)).encode()
    return int.from_bytes(hashlib.blake2b(data, key=key, digest_size=16).digest(), "big")


def permute(key: bytes, tweak: str, value: int, left: int, right: int) -> int:
    """Keyed bijection of 0 .. left * right - 1 (an alternating Feistel network)."""
    a, b = divmod(value, right)
    for r in range(0, 10, 2):
        a = (a + _number(key, tweak, r, b)) % left
        b = (b + _number(key, tweak, r + 1, a)) % right
    return a * right + b


def _in_alphabet(key: bytes, tweak: str, text: str, alphabet: str) -> str:
    """Bijection of the strings of one length over ``alphabet``."""
    n, k = len(text), len(alphabet)
    value = 0
    for c in text:
        value = value * k + alphabet.index(c)
    value = permute(key, f"{tweak}:{n}", value, k ** (n // 2), k ** (n - n // 2))
    out = []
    for _ in range(n):
        value, i = divmod(value, k)
        out.append(alphabet[i])
    return "".join(reversed(out))


def _refill(shape: str, fresh: str, taken: Callable[[str], bool]) -> str:
    """``shape`` with its taken characters replaced by those of ``fresh`` in order."""
    it = iter(fresh)
    return "".join(next(it) if taken(c) else c for c in shape)


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isascii() and c.isdigit())


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def iban_ok(text: str) -> bool:
    s = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def canonical(kind: str, text: str) -> str:
    """What mentions of one entity have in common."""
    if kind == "email":
        return text.lower()
    if kind in ("card", "ssn", "phone"):
        return ("+" if text.startswith("+") else "") + _digits(text)
    if kind == "iban":
        return text.replace(" ", "")
    return text


def _classes(key: bytes, tweak: str, whole: str, text: str) -> str:
    """Letters and digits replaced within their class by a stream keyed with ``whole``."""
    out = []
    stream = hashlib.shake_256(key + f"{tweak}\x1f{whole}".encode()).digest(2 * len(text))
    for i, c in enumerate(text):
        x = stream[2 * i] << 8 | stream[2 * i + 1]
        if c.isascii() and c.isdigit():
            out.append(str(x % 10))
        elif c.isalpha():
            low = "abcdefghijklmnopqrstuvwxyz"
            if "а" <= c.lower() <= "я":
                low = "абвгдежзиклмнопрстуфхцшэюя"
            elif "α" <= c.lower() <= "ω":
                low = "αβγδεζηθικλμνξοπρστυφχψω"
            d = low[x % len(low)]
            out.append(d.upper() if c.isupper() else d)
        else:
            out.append(c)
    return "".join(out)


#: Syllables of a built name; each further attempt has one more, so there is room for
#: any number of names.
SHORTEST = 4


def _family(key: bytes, name: str, attempt: int) -> str:
    script = "cyrillic" if re.search("[а-яё]", name.lower()) else "latin"
    parts = SYLLABLES[script]
    x = _number(key, "family", attempt, name.lower())
    return "".join(parts[x // len(parts) ** i % len(parts)] for i in range(SHORTEST + attempt)).capitalize()


def _given(key: bytes, name: str, gender: str | None, attempt: int) -> str:
    script = "cyrillic" if re.search("[а-яё]", name.lower()) else "latin"
    gender = GENDER.get(name) or gender or "fm"[_number(key, "gender", name.lower()) % 2]
    table = GIVEN[script, gender]
    if name in table and not attempt:  # a bijection of the table without fixed points
        i = table.index(name)
        return table[(i + 1 + _number(key, "given", script, gender) % (len(table) - 1)) % len(table)]
    parts = SYLLABLES[script]
    x = _number(key, "given", gender, attempt, name.lower())
    head = "".join(parts[x // len(parts) ** i % len(parts)] for i in range(SHORTEST + attempt))
    return (head + ENDINGS[script, gender]).capitalize()


def surrogate(key: bytes, kind: str, text: str, attempt: int = 0) -> str:
    """Replacement of entity ``text``; mentions with one canonical form agree up to
    their separators, case of e-mail addresses aside."""
    t = f"{kind}:{attempt}"
    if kind in ("ssn", "phone"):
        d = _digits(text)
        keep = len(re.match(r"\+(1|7|\d\d)", text).group(1)) if text.startswith("+") and len(d) > 9 else 0
        return _refill(text, d[:keep] + _in_alphabet(key, t, d[keep:], "0123456789"), str.isdigit)
    if kind == "card":
        d = _digits(text)
        if not luhn(d):
            fresh = _in_alphabet(key, t, d, "0123456789")
        else:
            body = d[0] + _in_alphabet(key, t, d[1:-1], "0123456789")
            fresh = body + next(c for c in "0123456789" if luhn(body + c))
        return _refill(text, fresh, str.isdigit)
    if kind == "iban":
        s = text.replace(" ", "")
        body = _classes(key, t, s, s[4:])
        number = "".join(str(int(c, 36)) for c in body + s[:2] + "00")
        return _refill(text, f"{s[:2]}{98 - int(number) % 97:02d}{body}", str.isalnum)
    if kind == "ip":
        value = 0
        for part in text.split("."):
            value = value << 8 | int(part)
        while True:  # walk the cycle to the next address that is an ordinary one
            value = permute(key, t, value, 1 << 16, 1 << 16)
            if 1 <= value >> 24 <= 223 and value >> 24 != 127:
                return ".".join(str(value >> s & 255) for s in (24, 16, 8, 0))
    if kind == "email":
        local, _, domain = text.lower().partition("@")
        labels = domain.split(".")
        # the provider keeps its shape and one replacement; the address moves to a reserved domain
        shown = [_classes(key, f"domain:{attempt}", domain, x) for x in labels[:-2]]
        if labels[-2] not in ("example", "co", "com"):
            shown.append(_classes(key, f"domain:{attempt}", domain, labels[-2]))
        ending = labels[-1] if labels[-1] in ("com", "org", "net") else "org"
        return _classes(key, t, text.lower(), local) + "@" + ".".join([*shown, "example", ending])
    if kind == "secret":
        if re.fullmatch("[0-9a-f]+|[0-9A-F]+", text):
            return _in_alphabet(key, t, text, "0123456789ABCDEF" if text.isupper() else "0123456789abcdef")
        head = re.match(r"(?:AKIA|gh[pousr]_|sk-|xox[abprs]-)?", text).group()
        return head + _classes(key, t, text, text[len(head):])
    raise ValueError(kind)


def _mentions(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, canonical form) in order, without overlaps. Within a text a
    name is one entity: a given name has the gender that any of its mentions tells, and
    names found by a form of address are found again wherever they stand after it."""
    found = list(_found(text)) if _HINT.search(text) else []
    names = {m[3]: m for m in reversed(found) if m[2] == "family" or m[2].startswith("given")}  # first mentions
    if not names:
        return found
    gender = {m[3]: m[2] for m in reversed(found) if m[2] in ("given:f", "given:m")}
    again = re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, sorted(names, key=len, reverse=True))) + r")(?!\w)")
    taken, k = [(a, b) for a, b, _, _ in found], 0
    for m in again.finditer(text, min(x[0] for x in names.values())):
        while k < len(taken) and taken[k][1] <= m.start():
            k += 1
        first = names[m.group()]
        if m.start() > first[0] and (k == len(taken) or taken[k][0] >= m.end()):
            found.append((*m.span(), first[2], m.group()))
    return sorted((a, b, gender.get(form, kind) if kind.startswith("given") else kind, form) for a, b, kind, form in found)


def _found(text: str) -> Iterator[tuple[int, int, str, str]]:
    """What the patterns find."""
    for m in _ALL.finditer(text):
        kind = next(k for k in PATTERNS if m.group(k) is not None)
        found = m.group(kind)
        if kind == "iban" and not iban_ok(found) or kind == "phone" and len(_digits(found)) < 8:
            continue
        if kind == "name":
            for part, a, b in _name_parts(m):
                yield a, b, part, text[a:b]
            continue
        yield m.start(), m.end(), kind, canonical(kind, found)


def _name_parts(m: re.Match) -> list[tuple[str, int, int]]:
    """A person's given names and family name as entities of their own, so that
    "Mrs Bell" and "Helena Bell" stay one family."""
    if m.group("given"):
        return [(f"given:{GENDER[m.group('given')]}", *m.span("given")), ("family", *m.span("family"))]
    form = m.group("form")
    gender = "f" if form in FEMALE else "m" if form in MALE else ""
    a = m.start("after")
    words = [(a + w.start(), a + w.end()) for w in re.finditer(r"\S+", m.group("after"))]
    given = [(f"given:{GENDER.get(m.string[slice(*w)], gender)}", *w) for w in words[:-1]]
    return [*given, ("family", *words[-1])]


def _fresh(key: bytes, kind: str, text: str, attempt: int) -> str:
    if kind.startswith("given:"):
        return _given(key, text, kind[6:] or None, attempt)
    if kind == "family":
        return _family(key, text, attempt)
    return surrogate(key, kind, text, attempt)


def replace(text: str | None, key: bytes, overrides: dict[tuple[str, str], int]) -> tuple[str | None, list[tuple]]:
    """(text with surrogates, [(kind, start, end, surrogate)] by offsets in the original)."""
    if not text:
        return text, []
    out, at, spans = [], 0, []
    for a, b, kind, form in _mentions(text):
        new = _fresh(key, kind, text[a:b], overrides.get((kind, form), 0))
        out += [text[at:a], new]
        spans.append((kind.partition(":")[0], a, b, new))
        at = b
    return ("".join(out) + text[at:] if out else text), spans


def entities(docs: DataFrame) -> DataFrame:
    """doc_id, kind, form: what each document mentions; narrow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (d.as_py(), kind, form)
                for d, t in zip(batch.column("doc_id"), batch.column("text"), strict=True)
                for kind, form in sorted({(k, f) for _, _, k, f in _mentions(t.as_py() or "")})
            ]
            columns = list(zip(*rows, strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.string())],
                names=["doc_id", "kind", "form"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, kind string, form string")


def overrides(found: DataFrame, key: bytes) -> DataFrame:
    """(kind, form, attempt) of the entities that may not use attempt 0.

    Each round draws the pending entities' surrogates, and keeps the smallest
    form of those that share one; a surrogate that is an original, or is already
    given, sends its entity to the next round. Given names of all genders are checked
    against each other.
    """
    spark = found.sparkSession
    distinct = cut_lineage(
        found.select("kind", "form").distinct().withColumn("sort", F.substring_index("kind", ":", 1)), "entities"
    )
    pending, settled, moved = distinct.withColumn("attempt", F.lit(0)), None, None

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = [
                canonical(k.as_py(), _fresh(key, k.as_py(), f.as_py(), a.as_py()))
                for k, f, a in zip(batch.column("kind"), batch.column("form"), batch.column("attempt"), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(new, pa.string())], names=[*batch.schema.names, "new"])

    originals = distinct.select("sort", F.col("form").alias("new"))
    for _ in range(MAX_ATTEMPTS):
        drawn = pending.mapInArrow(draw, "kind string, form string, sort string, attempt int, new string")
        first = drawn.groupBy("sort", "new").agg(F.min(F.struct("form", "kind", "attempt")).alias("_first"))
        good = first.select("sort", "_first.*", "new").join(originals, ["sort", "new"], "left_anti")
        if settled is not None:
            good = good.join(settled, ["sort", "new"], "left_anti")
        good = cut_lineage(good.select("kind", "form", "attempt", "sort", "new"), "surrogates")
        pending = cut_lineage(
            pending.join(good, ["kind", "form"], "left_anti").withColumn("attempt", F.col("attempt") + 1)
            .select("kind", "form", "sort", "attempt"), "surrogates-left"
        )
        settled = good.select("sort", "new") if settled is None else settled.unionAll(good.select("sort", "new"))
        late = good.where("attempt > 0").select("kind", "form", "attempt")
        moved = late if moved is None else moved.unionAll(late)
        if pending.isEmpty():
            return cut_lineage(moved, "overrides")
    raise RuntimeError(f"surrogates still collide after {MAX_ATTEMPTS} attempts")


def pseudonymise(docs: DataFrame, key: bytes, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, ``keep``, text with surrogates, and ``replaced``: kind, start, end (in
    the original) and surrogate of every mention."""
    found = cut_lineage(entities(docs), "mentions")
    late = overrides(found, key)
    by_doc = cut_lineage(
        found.join(late, ["kind", "form"]).groupBy(F.col("doc_id").alias("_doc"))
        .agg(F.collect_set(F.struct("kind", "form", "attempt")).alias("_late")), "overrides-by-doc",
    )
    # a stored table: the planner knows its size and moves the documents only if it is large
    wide = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *keep, "text").join(
        by_doc, F.col("doc_id").eqNullSafe(F.col("_doc")), "left"
    ).drop("_doc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("surrogate", pa.string())]))
        for batch in batches:
            texts, spans = [], []
            for t, late_here in zip(batch.column("text"), batch.column("_late"), strict=True):
                held = {(x["kind"], x["form"]): x["attempt"] for x in late_here.as_py() or ()}
                new, where = replace(t.as_py(), key, held)
                texts.append(new)
                spans.append([dict(zip(("kind", "start", "end", "surrogate"), w, strict=True)) for w in where])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(batch.column(k) for k in keep), pa.array(texts, pa.string()), pa.array(spans, kind)],
                names=["doc_id", *keep, "text", "replaced"],
            )

    fields = "".join(f"`{k}` {docs.schema[k].dataType.simpleString()}, " for k in keep)
    return wide.mapInArrow(
        run, f"doc_id long, {fields}text string, replaced array<struct<kind:string,start:int,end:int,surrogate:string>>"
    )
