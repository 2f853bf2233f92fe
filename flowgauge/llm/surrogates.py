"""PII surrogates: every detected entity is replaced by a keyed one of its own kind.

Detected, by one pattern each: mail addresses, card numbers (13 to 19 digits), phone numbers, IPv4 and IPv6
addresses, social security numbers, IBANs, quoted secrets after a credential word, key-shaped secrets, and person
names: a title with capitalised words, or a listed first name with a capitalised word.

**Surrogates** are functions of (key, kind, value, attempt) by HMAC-like SHA-256 and keep the value's form: digits
become digits, letters stay letters of their script and case, separators stay. On top, mail addresses keep
example domains' shape, IPv4 parts stay below 256, a phone number's country code and a card's first digit stay, hex
secrets stay hex. A name is replaced word by word: first names from the list of the same gender and script (told by the
title or the first name), other words by invented names of the script and, where the script marks it, gender.
The same value has the same surrogate in every document (coreference), also when only a part of a name is repeated.

**Collision checks.** All distinct values of the corpus are gathered (counted before the shuffle). A surrogate that
equals any detected value, or a surrogate of another value, moves to its next attempt; of colliding values the
smallest keeps its own. Rounds are repeated until no collision is left, each over the values still in
question only. Values with a later attempt are few; a table of them is joined to the documents that hold them.

Null text stays null, empty stays empty; documents without entities are unchanged. Repeated rows get the same
replacement. Long texts are handled whole. Input columns named like an output column are replaced. Everything is
DataFrame functions; texts are searched once, and shuffled only if the measured override table is too large to be sent to all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgauge.llm.common import stored

# Titles by gender, and first names by gender and script.
TITLES = {
    "m": ("Mr", "Sir", "Herr", "Monsieur", "Señor", "Sr", "господин"),
    "f": ("Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Señorita", "госпожа"),
    "n": ("Dr", "Prof", "Doctor", "Professor", "доктор"),
}
FIRST_NAMES = {
    ("m", "latin"): ("James", "John", "Robert", "Michael", "William", "David", "Richard", "Joseph", "Thomas", "Charles", "Daniel", "Matthew", "Peter", "Paul", "Hans", "Klaus", "Jürgen", "Pierre", "Jacques", "Luc", "Carlos", "Juan", "Pedro", "Miguel"),
    ("f", "latin"): ("Mary", "Patricia", "Jennifer", "Linda", "Elizabeth", "Barbara", "Susan", "Jessica", "Sarah", "Karen", "Anna", "Emma", "Ursula", "Heike", "Sabine", "Marie", "Claire", "Sophie", "Carmen", "María", "Lucía", "Elena", "Julia", "Laura"),
    ("m", "cyrillic"): ("Александр", "Дмитрий", "Иван", "Сергей", "Андрей", "Николай", "Пётр", "Михаил"),
    ("f", "cyrillic"): ("Анна", "Мария", "Елена", "Ольга", "Наталья", "Татьяна", "Ирина", "Светлана"),
}
# Syllables of invented names by script.
SYLLABLES = {
    "latin": ("ba", "bel", "car", "cor", "da", "den", "fal", "gar", "hal", "hen", "jor", "ka", "ker", "lan", "lor", "mar", "mel", "nor", "or", "pal", "per", "ral", "ros", "sal", "ser", "tal", "tor", "val", "ver", "wal", "win", "zan"),
    "cyrillic": ("ба", "бел", "вар", "вол", "гор", "дан", "дол", "зан", "ка", "кор", "лан", "лев", "мар", "мел", "нов", "ор", "пал", "пет", "рам", "рос", "сал", "сер", "тар", "том", "фад", "хол", "цар", "чер", "шал", "щер", "юр", "яр"),
}

UPPER, LETTER = r"\p{Lu}", r"[\p{L}'’\-]"
_words = "|".join(sorted((t for x in TITLES.values() for t in x), key=lambda t: (-len(t), t)))
_firsts = "|".join(sorted((n for x in FIRST_NAMES.values() for n in x), key=lambda t: (-len(t), t)))
_title_starts = "".join(sorted({t[0] for x in TITLES.values() for t in x}))
NAME_WORD = rf"{UPPER}{LETTER}*\p{{L}}"

#: Kind and pattern, tried in this order at each position. Most positions are inside a word of prose: looks at one character
#: (where the last match ended, \G, a word may also begin) let a branch fail there at once.
PATTERNS = (
    ("email", r"(?:(?<![A-Za-z0-9\p{L}._%+\-])|\G)[A-Za-z0-9\p{L}._%+\-]++@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)*\.[A-Za-z]{2,}"),
    ("secret", r"(?=[TtSsPpAa])(?i:token|secret|password|passwd|pwd|api[_\- ]?key|access[_\- ]?key)\s*[:=]\s*\"[^\"\s]{6,}\""),
    ("key", r"\b(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,}|eyJ[A-Za-z0-9_\-]{10,}\.[A-Za-z0-9_\-]{10,}\.[A-Za-z0-9_\-]{10,})"),
    ("iban", r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b"),
    ("ssn", r"\b\d{3}-\d{2}-\d{4}\b"),
    ("phone", r"\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)[ .\-]?)?\d{2,4}(?:[ .\-]?\d{2,4}){1,4}\b|\(\d{3}\) ?\d{3}[\-. ]\d{4}\b|\b\d{3}[\-.]\d{3}[\-.]\d{4}\b"),
    ("ipv4", r"\b(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)\b"),
    ("ipv6", r"\b(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}\b"),
    ("card", r"(?<![.\d])\b\d(?:[ \-]?\d){12,18}\b"),
    ("title", rf"\b(?=[{_title_starts}])(?:{_words})\.? {NAME_WORD}(?: {NAME_WORD}){{0,2}}"),
    ("name", rf"\b(?=\p{{Lu}})(?:{_firsts}) {NAME_WORD}"),
)
PATTERN = "|".join(f"(?:{p})" for _, p in PATTERNS)


def kind_of(value: Column) -> Column:
    """The kind whose pattern matches the whole value."""
    return F.coalesce(*[F.when(F.regexp_like(value, F.lit(f"^(?:{p})$")), F.lit(k)) for k, p in PATTERNS], F.lit("other"))


def _digest(key: str, kind: Column, value: Column, attempt: Column) -> Column:
    inner = F.sha2(F.concat_ws("\x1f", F.lit(key), kind, value, attempt.cast("string")), 256)
    return F.sha2(F.concat_ws("\x1f", F.lit(key), inner), 256)


def _byte(digest: Column, i: Column) -> Column:
    """Byte i of an unending stream: the digest of the digest and the block number."""
    block = F.sha2(F.concat(digest, F.floor(i / 32).cast("string")), 256)
    return F.conv(F.substr(block, (i % 32 * 2 + 1).cast("int"), F.lit(2)), 16, 10).cast("int")


def _reformed(value: Column, digest: Column, hexes: bool = False) -> Column:
    """Each character replaced by one of its own class; others stay."""
    chars = F.split(value, "")

    def one(c: Column, i: Column) -> Column:
        b = _byte(digest, i)
        pick = lambda alphabet: F.substr(F.lit(alphabet), b % len(alphabet) + 1, F.lit(1))
        out = F.when(c.rlike("[0-9]"), pick("0123456789"))
        if hexes:
            out = out.when(c.rlike("[a-f]"), pick("abcdef")).when(c.rlike("[A-F]"), pick("ABCDEF"))
        return (
            out.when(c.rlike("[a-z]"), pick("abcdefghijklmnopqrstuvwxyz"))
            .when(c.rlike("[A-Z]"), pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
            .when(c.rlike(r"\p{IsCyrillic}") & c.rlike(r"\p{Ll}"), pick("абвгдежзиклмнопрстуфхцчшэюя"))
            .when(c.rlike(r"\p{IsCyrillic}"), pick("АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ"))
            .when(c.rlike(r"\p{IsGreek}") & c.rlike(r"\p{Ll}"), pick("αβγδεζηθικλμνξοπρστυφχψω"))
            .when(c.rlike(r"\p{IsGreek}"), pick("ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ"))
            .when(c.rlike(r"\p{Ll}"), pick("àáâãäåæçèéêëìíîïñòóôõöùúûüý"))
            .when(c.rlike(r"\p{Lu}"), pick("ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝ"))
            .otherwise(c)
        )

    return F.array_join(F.transform(chars, one), "")


def _ipv4(digest: Column) -> Column:
    return F.concat_ws(".", F.lit("10"), *[_byte(digest, F.lit(i)).cast("string") for i in range(3)])


def _invented(digest: Column, script: str, gender: Column) -> Column:
    """A capitalised name of three or four syllables; in Cyrillic with the ending of the gender."""
    syllables = SYLLABLES[script]
    part = lambda i: F.element_at(F.array(*map(F.lit, syllables)), _byte(digest, F.lit(i)) % len(syllables) + 1)
    stem = F.initcap(F.concat(part(0), part(1), part(2), F.when(_byte(digest, F.lit(3)) % 2 == 0, part(4)).otherwise("")))
    if script == "cyrillic":
        return F.concat(stem, F.when(gender == "f", F.lit("ова")).otherwise(F.lit("ов")))
    return F.concat(stem, F.element_at(F.array(*map(F.lit, ("s", "n", "ton", "ley", "mann", "ez"))), _byte(digest, F.lit(5)) % 6 + 1))


def _listed(words: tuple[str, ...], column: Column) -> Column:
    return column.isin(*words)


def surrogate(key: str, kind: Column, value: Column, attempt: Column) -> Column:
    """The replacement of a value. Kinds of name words are ``first:m``, ``first:f`` and ``last:m``, ``last:f``, ``last:n``."""
    digest = _digest(key, kind, value, attempt)
    gender = F.substring_index(kind, ":", -1)
    cyrillic = value.rlike(r"\p{IsCyrillic}")
    by_form = _reformed(value, digest)
    local, domain = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    tld = F.substring_index(domain, ".", -1)
    stem = F.substr(domain, F.lit(1), F.length(domain) - F.length(tld))
    first = lambda g, s: F.element_at(
        F.array(*map(F.lit, FIRST_NAMES[g, s])), F.conv(F.substr(digest, F.lit(1), F.lit(6)), 16, 10).cast("int") % len(FIRST_NAMES[g, s]) + 1)
    # more first names than are listed take an invented second part, so that different names stay different
    doubled = lambda g, s: F.when(attempt == 0, first(g, s)).otherwise(F.concat(first(g, s), F.lit("-"), _invented(digest, s, F.lit(g))))
    return (
        F.when(kind == "email", F.concat(_reformed(local, digest), F.lit("@"), _reformed(stem, F.sha2(digest, 256)), tld))
        .when(kind == "secret", F.concat(F.regexp_extract(value, "^[^\"]*\"", 0), _reformed(F.regexp_extract(value, "\"([^\"]*)\"", 1), digest, hexes=True), F.lit('"')))
        .when(kind == "ipv4", _ipv4(digest))
        .when(kind == "ipv6", _reformed(value, digest, hexes=True))
        .when(kind == "phone", F.concat(F.regexp_extract(value, r"^\+\d+(?=[ .\-(])|^", 0), _reformed(F.regexp_replace(value, r"^\+\d+(?=[ .\-(])", ""), digest)))
        .when(kind == "card", F.concat(F.substr(value, F.lit(1), F.lit(1)), _reformed(F.substr(value, F.lit(2)), digest)))
        .when(kind == "iban", F.concat(F.substr(value, F.lit(1), F.lit(2)), _reformed(F.substr(value, F.lit(3)), digest)))
        .when((kind == "first:m") & cyrillic, doubled("m", "cyrillic"))
        .when((kind == "first:f") & cyrillic, doubled("f", "cyrillic"))
        .when(kind == "first:m", doubled("m", "latin"))
        .when(kind == "first:f", doubled("f", "latin"))
        .when(F.startswith(kind, F.lit("last")) & cyrillic, _invented(digest, "cyrillic", gender))
        .when(F.startswith(kind, F.lit("last")), _invented(digest, "latin", gender))
        .otherwise(by_form)
    )


def parts_of(match: Column) -> Column:
    """The replaceable parts of a match: (kind, value), one for all kinds but names, there one for each word."""
    kind = kind_of(match)
    words = F.split(match, " ")
    title = F.regexp_replace(F.element_at(words, 1), r"\.$", "")
    listed = lambda g: _listed(tuple(n for (x, _), names in FIRST_NAMES.items() if x == g for n in names), F.element_at(words, F.when(kind == "title", 2).otherwise(1)))
    gender = (
        F.when((kind == "title") & _listed(TITLES["m"], title), F.lit("m"))
        .when((kind == "title") & _listed(TITLES["f"], title), F.lit("f"))
        .when(listed("m"), F.lit("m")).when(listed("f"), F.lit("f")).otherwise(F.lit("n"))
    )
    names = F.when(kind == "title", F.slice(words, F.lit(2), F.size(words))).otherwise(words)
    cyrillic = match.rlike(r"\p{IsCyrillic}")

    def word(w: Column, i: Column) -> Column:
        given = lambda g: _listed(tuple(n for (x, _), names in FIRST_NAMES.items() if x == g for n in names), w)
        # in Latin script a family name has no gender, so that a couple's stays the same
        last = F.when(cyrillic, F.concat(F.lit("last:"), gender)).otherwise(F.lit("last:n"))
        first = F.when(given("m"), F.lit("first:m")).when(given("f"), F.lit("first:f"))
        first = first.when((F.size(names) > 1) & (gender != "n"), F.concat(F.lit("first:"), gender))
        return F.struct(F.when(i == 0, F.coalesce(first, last)).otherwise(last).alias("kind"), w.alias("value"))

    whole = F.array(F.struct(kind.alias("kind"), match.alias("value")))
    return F.when(kind.isin("title", "name"), F.transform(names, word)).otherwise(whole)


def entities(found: DataFrame) -> DataFrame:
    """One row for each replaceable part of the rows' ``pii_matches``, in text order (repeats included)."""
    matches = found.where(F.size("pii_matches") > 0).select("doc_id", F.explode("pii_matches").alias("match"))
    parts = matches.select("doc_id", F.explode(parts_of(F.col("match"))).alias("part"))
    return parts.select("doc_id", "part.kind", "part.value")


def attempts(values: DataFrame, key: str) -> DataFrame:
    """Distinct (kind, value) with the first attempt whose surrogate is free; only those above 0."""
    real = values.select(F.col("value").alias("surrogate")).distinct()
    trial = values.withColumn("attempt", F.lit(0))
    while True:
        made = trial.withColumn("surrogate", surrogate(key, F.col("kind"), F.col("value"), F.col("attempt")))
        made = made.join(real.withColumn("is_real", F.lit(True)), "surrogate", "left")
        # a free surrogate goes to one value: the one that tries it earliest, then the smallest
        claim = F.min(F.struct("attempt", "kind", "value"))
        winner = made.groupBy("surrogate").agg(claim.alias("claim"))
        judged = made.join(winner, "surrogate").withColumn(
            "clash", F.col("is_real").isNotNull() | (F.struct("attempt", "kind", "value") != F.col("claim")))
        judged = stored(judged.select("kind", "value", "attempt", "clash"), "pii-attempts")
        if judged.where("clash").isEmpty():
            return judged.where("attempt > 0").select("kind", "value", "attempt")
        trial = judged.select("kind", "value", (F.col("attempt") + F.col("clash").cast("int")).alias("attempt"))


def pseudonymized(docs: DataFrame, key: str = "fixed-test-key", text: str = "text") -> DataFrame:
    """docs with the text's entities replaced and ``n_entities`` (long), the number of replaced matches."""
    docs = docs.drop(*[c for c in docs.columns if c.lower() in ("n_entities", "pii_override", "pii_matches")])
    # texts are searched once; the matches lie beside them in a written table
    docs = stored(docs.withColumn("pii_matches", F.regexp_extract_all(F.col(text), F.lit(PATTERN), F.lit(0))), "pii-matches")
    found = stored(entities(docs).groupBy("doc_id", "kind", "value").count(), "pii-entities")
    later = attempts(found.select("kind", "value").distinct(), key)
    entry = F.struct(F.concat_ws("\x1f", "kind", "value").alias("k"), F.col("attempt").alias("v"))
    overrides = found.join(later, ["kind", "value"]).groupBy("doc_id").agg(F.map_from_entries(F.collect_set(entry)).alias("pii_override"))
    overrides = stored(overrides.withColumnRenamed("doc_id", "pii_doc"), "pii-overrides")
    docs = docs.join(overrides, docs["doc_id"].eqNullSafe(overrides["pii_doc"]), "left").drop("pii_doc")
    matches = F.col("pii_matches")
    hit = F.coalesce(F.size(matches), F.lit(0)) > 0
    rest = F.split(F.col(text), PATTERN, -1)

    def replaced(match: Column) -> Column:
        parts = parts_of(match)
        one = lambda p: surrogate(key, p["kind"], p["value"], F.coalesce(F.col("pii_override")[F.concat_ws("\x1f", p["kind"], p["value"])], F.lit(0)))
        made = F.array_join(F.transform(parts, one), " ")
        title = F.when(kind_of(match) == "title", F.concat(F.substring_index(match, " ", 1), F.lit(" "))).otherwise(F.lit(""))
        return F.concat(title, made)

    pieces = F.zip_with(rest, F.transform(matches, replaced), lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    return docs.withColumns({
        text: F.when(hit, F.array_join(pieces, "")).otherwise(F.col(text)),
        "n_entities": F.when(hit, F.size(matches)).otherwise(F.lit(0)).cast("long"),
    }).drop("pii_override", "pii_matches")
