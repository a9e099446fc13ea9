"""PII surrogates: keyed, type-consistent replacements that keep distinctness and coreference.

Detected are e-mail addresses, telephone numbers, IPv4 addresses, payment card
and other long numbers, social security numbers, secrets (long hexadecimal
strings, quoted values of passwords and keys), and names of persons. A name is told
by where it stands: after a salutation, a title, a closing line or a label such as
"contact:", after "my name is", right before an address or a telephone number in
brackets, or as a run of capitalised words that begins with a known given name. All
parts of a name so found are replaced wherever they stand capitalised in the text.
Lists tell the gender of given names; one that they do not hold has none, and gets a
surrogate that could be either.

An entity is its type and canonical form (digits of a number, lower-cased
address, a name's word with gender and script), so mentions in different formats
are one entity. Its surrogate comes from an HMAC under the key over type,
canonical form and attempt: digits for digits in the mention's own format, a
card number with its check digit right if it was, a name of the same gender, script
and case, hexadecimal of the same length with the case of its letters, an address in
capitals, or with a capital letter first, if the mention is. Equal entities get equal surrogates in
all documents, on every run with the key.

Collision checks over the whole corpus: the distinct entities are one table; an
entity whose surrogate is another entity's surrogate, or a real entity, draws
again with the next attempt (of those that collide the smallest canonical form
keeps its draw). Rounds end when none collides. Few entities ever draw again;
only texts that mention one of those are joined with its attempt.

Defined cases: NULL texts stay NULL with no entity; empty texts stay empty;
repeated rows are replaced alike; NULL ids are kept; an empty table gives no
rows; other columns are ignored. Texts are read whole.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldnotes.llm.util import cut, slices, table

KEY = b"surrogates of the test tables"  # a parameter; production takes its own
MOST_ROUNDS = 50

# Given names by gender, titles by gender.
MALE = frozenset("""James John Robert Michael William David Richard Joseph Thomas Charles Daniel Matthew Anthony Steven Paul
 Andrew Kenneth George Edward Brian Pierre Michel Philippe Alain Jacques Hans Peter Wolfgang Klaus Jürgen Stefan Carlos José
 Manuel Miguel Pedro Luis Иван Сергей Андрей Дмитрий Алексей Николай Γιώργος Νίκος Κώστας""".split())
FEMALE = frozenset("""Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Nancy Margaret Sandra Emily Laura
 Helen Anna Alice Marie Isabelle Sylvie Catherine Nathalie Françoise Ursula Monika Petra Sabine Heike Ingrid Carmen Isabel Lucía
 Elena Sofía Rosa Мария Елена Ольга Наталья Анна Светлана Μαρία Ελένη Κατερίνα""".split())
TITLES = {"Mr": "m", "Mister": "m", "Herr": "m", "Monsieur": "m", "Señor": "m", "Sir": "m", "Mrs": "f", "Ms": "f", "Miss": "f",
          "Frau": "f", "Madame": "f", "Mme": "f", "Señora": "f", "Lady": "f"}
# Consonants, vowels, male and female endings by script.
SCRIPTS = {
    "LATIN": ("bcdfghklmnprstvw", "aeiou", ("n", "r", "s", "lf"), ("a", "ia", "ina", "elle")),
    "CYRILLIC": ("бвгдзклмнпрстф", "аеиоу", ("н", "р", "й", "слав"), ("а", "ия", "ина", "ья")),
    "GREEK": ("βγδθκλμνπρστφ", "αειου", ("ος", "ης", "ας"), ("α", "η", "ια")),
}

HEX = re.compile(r"(?<![0-9A-Za-z])(?=[0-9A-Fa-f]{0,31}[0-9])[0-9A-Fa-f]{32,}(?![0-9A-Za-z])")
SECRET = re.compile(r"(?i)(?<![a-z])(?:password|passwd|secret|token|api[_ -]?key)\s*[=:]\s*[\"']([^\"'\s]{8,})[\"']")
ADDRESS = re.compile(r"[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}")
NUMBER = re.compile(r"(?<![\w.+-])(?:\+[0-9]|\([0-9]|[0-9])[0-9 .()-]{5,}[0-9](?![\w-]|\.[0-9])")
IP = re.compile(r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}")
SSN = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}")
CARD = re.compile(r"[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}")
PHONE = re.compile(r"(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,3}|\+[0-9]{8,15}")
NAME_WORD = r"[^\W\d_a-z][^\W\d_]+(?:[-'’][^\W\d_]+)*"
NAME_RUN = re.compile(rf"(?<!\w){NAME_WORD}\.?(?: {NAME_WORD}\.?)+")
# What stands before a name, and words that stand there instead of one.
SPOKEN_TO = r"(?:Dear|Hello|Hi|Hey|Liebe|Lieber|Cher|Chère|Querido|Querida|Уважаемый|Уважаемая|Αγαπητέ|Αγαπητή)\s+"
CLOSING = r"(?:[Rr]egards|[Ss]incerely|[Bb]est wishes|[Tt]hanks|[Cc]heers|Grüßen|Cordialement|Saludos|уважением),?[ \t]*\n\s*"
LABEL = r"(?:(?i:name|contact|author|customer|patient|employee|signed|attn|sender|recipient)[ \t]*:[ \t]*|[Mm]y name is )"
ONE_NAME = rf"({NAME_WORD}(?: {NAME_WORD})*)"
CONTEXT = re.compile(rf"(?<!\w)(?:{SPOKEN_TO}{ONE_NAME}(?=[,!:])|(?:{CLOSING}|{LABEL}){ONE_NAME}(?![\w@]))")
NOBODY = frozenset("The Our Your My A An Sir Madam Customer Customers Reader Readers All Team Friend Friends Colleague Colleagues Everyone".split())
NOBODY = frozenset("The Our Your My A An Sir Madam Customer Customers Reader Readers All Team Friend Friends Colleague Colleagues Everyone".split())
BEFORE = re.compile(rf"(?<!\w)({NAME_WORD}(?: {NAME_WORD}){{1,2}}) ?[(<](?=[^)>\s]*@|\+?[0-9(])")
#: One of these words is in every text with such a place.
HINTS = tuple("""dear hello hi hey lieb cher querid уважаем αγαπητ regards sincerely wishes thanks grüßen cordialement saludos уважением
 name contact author customer patient employee signed attn sender recipient""".split())
REACHED = re.compile(r"[(<](?=[^)>\s]*@|\+?[0-9(])")  # an address or a number in brackets
ENDS_WITH_NAME = re.compile(rf"(?<!\w)({NAME_WORD}(?: {NAME_WORD}){{1,2}}) ?$")

Mention = tuple[int, int, str, str]  # start, stop, type, canonical form


def digits(s: str) -> str:
    return re.sub(r"\D", "", s)


def luhn(number: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(number)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def number_entity(s: str) -> tuple[str, str] | None:
    """Type and canonical form of a run of digits and separators."""
    if IP.fullmatch(s):
        return "ip", s
    if SSN.fullmatch(s):
        return "ssn", digits(s)
    d = digits(s)
    if CARD.fullmatch(s):
        return ("card" if luhn(d) else "number"), d
    if PHONE.fullmatch(s) and 9 <= len(d) <= 15:
        return "phone", d[-10:]
    return None


def script_of(word: str) -> str:
    script = unicodedata.name(word[0], "LATIN").split()[0]
    return script if script in SCRIPTS else "LATIN"


def names_in(text: str) -> list[Mention]:
    """Names of persons. Once a full name is known, its words are replaced wherever they stand capitalised in the text."""
    known: dict[str, str] = {}
    low = text.lower()
    places = [m[m.lastindex] for m in CONTEXT.finditer(text)] if any(h in low for h in HINTS) else []
    places += [m[1] for x in REACHED.finditer(text) if (m := ENDS_WITH_NAME.search(text[max(0, x.start() - 120) : x.start()]))]
    for words in (place.split(" ") for place in places):
        if words[0] not in TITLES and words[0] not in NOBODY:  # titles: with the runs below
            gender = "m" if words[0] in MALE else "f" if words[0] in FEMALE else "u"
            known.setdefault(words[0], f"given {gender}")
            for later in words[1:]:
                known.setdefault(later, "family")
    for run in NAME_RUN.finditer(text):
        words = run[0].split(" ")
        for i, word in enumerate(words[:-1]):
            bare = word.rstrip(".")
            gender = "m" if bare in MALE else "f" if bare in FEMALE else ""
            if gender and word == bare:
                known.setdefault(bare, f"given {gender}")
            elif bare in TITLES:
                gender = TITLES[bare]
                if words[i + 1].rstrip(".") in MALE | FEMALE:
                    continue
            else:
                continue
            for later in words[i + 1 :]:
                known.setdefault(later.rstrip("."), "family")
                if later.endswith("."):
                    break
            break
    if not known:
        return []
    known |= {w.upper(): kind for w, kind in known.items()}
    word = re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, sorted(known, key=len, reverse=True))) + r")(?!\w)")
    return [(m.start(), m.end(), f"{known[m[0]]} {script_of(m[0])}", m[0].casefold()) for m in word.finditer(text)]


def mentions(text: str) -> list[Mention]:
    """The entities in a text, left to right, not overlapping; of two that overlap the first, then the longer stays."""
    found: list[Mention] = []
    if "@" in text:
        at = text.find("@")
        while at >= 0:
            begin = at
            while begin > 0 and at - begin < 64 and (text[begin - 1].isascii() and (text[begin - 1].isalnum() or text[begin - 1] in "._%+-")):
                begin -= 1
            if m := ADDRESS.match(text, begin):
                found.append((m.start(), m.end(), "email", m[0].lower()))
            at = text.find("@", at + 1)
    for m in HEX.finditer(text):
        found.append((m.start(), m.end(), "secret", m[0]))
    for m in SECRET.finditer(text):
        found.append((m.start(1), m.end(1), "secret", m[1]))
    for m in NUMBER.finditer(text):
        if e := number_entity(m[0]):
            found.append((m.start(), m.end(), *e))
        else:  # several numbers in a row
            for part in re.finditer(r"\S+", m[0]):
                s = part[0].rstrip(".")
                if e := number_entity(s):
                    found.append((m.start() + part.start(), m.start() + part.start() + len(s), *e))
    found += names_in(text)
    found.sort(key=lambda x: (x[0], -x[1]))
    out, end = [], 0
    for x in found:
        if x[0] >= end:
            out.append(x)
            end = x[1]
    return out


class Stream:
    """Keyed choices for one entity and attempt."""

    def __init__(self, key: bytes, kind: str, canonical: str, attempt: int) -> None:
        self.seed, self.block, self.value = hmac.new(key, f"{kind}\0{canonical}\0{attempt}".encode(), hashlib.sha256).digest(), 0, 0

    def below(self, n: int) -> int:
        if self.value < 1 << 64:
            self.value = int.from_bytes(hashlib.sha256(self.seed + self.block.to_bytes(4, "big")).digest(), "big")
            self.block += 1
        self.value, x = divmod(self.value, n)
        return x

    def pick(self, items):
        return items[self.below(len(items))]


def surrogate(key: bytes, kind: str, canonical: str, attempt: int = 0) -> str:
    """The canonical form that stands for an entity: of the same type, length and character classes."""
    s = Stream(key, kind, canonical, attempt)
    if kind == "ip":
        return ".".join(str(x) for x in (1 + s.below(223), s.below(256), s.below(256), 1 + s.below(254)))
    if kind == "email":
        local, _, domain = canonical.partition("@")
        name = "".join(s.pick("abcdefghijklmnopqrstuvwxyz") if i == 0 else s.pick("abcdefghijklmnopqrstuvwxyz0123456789") for i in range(max(10, len(local))))
        return f"{name}@{''.join(s.pick('abcdefghijklmnopqrstuvwxyz') for _ in range(6))}.example.{domain.rpartition('.')[2]}"
    if kind == "secret":
        if HEX.fullmatch(canonical):
            letters = [c for c in canonical if c.isalpha()]
            if letters and any(c.isupper() for c in letters) and any(c.islower() for c in letters):  # the case of each letter stays
                return "".join(s.pick("0123456789") if c.isdigit() else s.pick("ABCDEF" if c.isupper() else "abcdef") for c in canonical)
            return "".join(s.pick("0123456789ABCDEF" if canonical.upper() == canonical else "0123456789abcdef") for _ in canonical)
        return "".join(s.pick("0123456789") if c.isdigit() else s.pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ") if c.isupper()
                       else s.pick("abcdefghijklmnopqrstuvwxyz") if c.isalpha() else c for c in canonical)
    if kind in ("card", "number", "phone", "ssn"):
        first = canonical[0] if kind == "card" else str(2 + s.below(8)) if kind == "phone" else str(1 + s.below(9))
        body = first + "".join(s.pick("0123456789") for _ in canonical[1:])
        if kind in ("card", "number"):  # the last digit makes the check right, or wrong as it was
            last = next(d for d in "0123456789" if luhn(body[:-1] + d))
            body = body[:-1] + (last if kind == "card" else str((int(last) + 1 + s.below(9)) % 10))
        return body
    role, *gender, script = kind.split()
    consonants, vowels, male, female = SCRIPTS[script]
    stem = "".join(s.pick(consonants) + s.pick(vowels) for _ in range(3 if role == "given" else 4))
    endings = {("m",): male, ("f",): female}.get(tuple(gender), male + female)
    return stem + (s.pick(endings) if role == "given" else s.pick(consonants))


def rendered(kind: str, mention: str, replacement: str) -> str:
    """The surrogate in the format of the mention: its separators and leading digits, or its case."""
    if kind in ("card", "number", "phone", "ssn"):
        out, left = list(mention), len(replacement)
        for i in range(len(out) - 1, -1, -1):
            if out[i].isdigit() and left:
                left -= 1
                out[i] = replacement[left]
        return "".join(out)
    if kind.startswith(("given", "family")):
        return replacement.upper() if mention.isupper() and len(mention) > 1 else replacement[0].upper() + replacement[1:]
    if kind == "email":
        return replacement.upper() if mention.isupper() else replacement[0].upper() + replacement[1:] if mention[0].isupper() else replacement
    return replacement


def entities(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(kind, canonical): the distinct entities of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            found = sorted({m[2:] for t in b.column("text").to_pylist() for m in mentions(t)})
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.string()) for i in (0, 1)], ["kind", "canonical"])

    texts = docs.select(F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL")
    return texts.mapInArrow(run, "kind string, canonical string").distinct()


def drawn(known: DataFrame, key: bytes) -> DataFrame:
    """``known`` (kind, canonical, attempt) with the surrogate of that attempt."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [surrogate(key, *x) for x in zip(*(b.column(c).to_pylist() for c in ("kind", "canonical", "attempt")))]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("kind", "canonical", "attempt")), pa.array(made, pa.string())],
                                             ["kind", "canonical", "attempt", "surrogate"])

    return known.mapInArrow(run, "kind string, canonical string, attempt int, surrogate string")


def attempts(known: DataFrame, key: bytes) -> DataFrame:
    """(kind, canonical, attempt, surrogate) of all entities, without collisions. Kinds that read alike are checked together."""
    group = F.when(F.col("kind").isin("card", "number", "phone", "ssn"), "digits").when(F.col("kind").rlike("^(given|family)"), "name").otherwise(F.col("kind"))
    state = cut(drawn(known.select("kind", "canonical", F.lit(0).alias("attempt")), key), "pii-entities")
    for _ in range(MOST_ROUNDS):
        rows = state.withColumn("group", group)
        # who keeps a surrogate that several drew
        first = rows.groupBy("group", "surrogate").agg(F.min(F.concat_ws("\0", "canonical", "kind")).alias("first"), F.count("*").alias("n"))
        first = first.where("n > 1").drop("n")
        real = rows.select(F.col("group").alias("g"), F.col("canonical").alias("c")).distinct()
        rows = rows.join(first, ["group", "surrogate"], "left").join(real, (F.col("group") == F.col("g")) & (F.col("surrogate") == F.col("c")), "left")
        lost = F.col("g").isNotNull() | (F.col("first").isNotNull() & (F.col("first") != F.concat_ws("\0", "canonical", "kind")))
        rows = cut(rows.select("kind", "canonical", "attempt", "surrogate", lost.alias("lost")), "pii-checked")
        if rows.where("lost").isEmpty():
            return state
        again = drawn(rows.where("lost").select("kind", "canonical", (F.col("attempt") + 1).alias("attempt")), key)
        state = cut(rows.where("NOT lost").drop("lost").unionByName(again), "pii-entities")
    raise RuntimeError("surrogates still collide")


def replace(docs: DataFrame, key: bytes = KEY, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text (with surrogates), n_entities (mentions replaced) and kinds (of them, distinct, sorted) of every row."""
    known = attempts(entities(docs, text_col), key)
    redrawn = known.where("attempt > 0").select("kind", "canonical", "attempt")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("k", F.xxhash64("text"))
    if redrawn.isEmpty():
        rows = rows.withColumn("again", F.lit(None).cast("map<string,int>"))
    else:
        rows = rows.join(of_texts(rows.select("k", "text"), redrawn), "k", "left")
    names = ["doc_id", "text", "n_entities", "kinds"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts, counts, kinds = [], [], []
            for text, again in zip(b.column("text").to_pylist(), b.column("again").to_pylist()):
                found = mentions(text) if text else []
                again = dict(again or ())
                parts, at = [], 0
                for start, stop, kind, canonical in found:
                    made = surrogate(key, kind, canonical, again.get(f"{kind}\0{canonical}", 0))
                    parts += [text[at:start], rendered(kind, text[start:stop], made)]
                    at = stop
                texts.append("".join([*parts, text[at:]]) if found else text)
                counts.append(len(found))
                kinds.append(sorted({m[2].split()[0] for m in found}))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(kinds, pa.list_(pa.string()))], names)

    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text string, n_entities long, kinds array<string>"
    return rows.select("doc_id", "text", "again").mapInArrow(run, schema)


def of_texts(texts: DataFrame, redrawn: DataFrame) -> DataFrame:
    """(k, again): for the texts that mention an entity drawn again, the attempts of these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            found = sorted({(k, *m[2:]) for k, t in zip(b.column("k").to_pylist(), b.column("text").to_pylist()) if t for m in mentions(t)})
            cols = list(zip(*found)) if found else ([], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.string()))], ["k", "kind", "canonical"])

    said = texts.mapInArrow(run, "k long, kind string, canonical string").distinct().join(redrawn, ["kind", "canonical"])
    entry = F.struct(F.concat_ws("\0", "kind", "canonical"), "attempt")
    return said.groupBy("k").agg(F.map_from_entries(F.collect_list(entry)).alias("again"))  # as many as a text mentions


def op4_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace(table(spark, sf_dir, "documents"))
