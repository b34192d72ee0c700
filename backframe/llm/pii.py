"""Personal data replaced by keyed surrogates of the same type and format."""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from backframe.llm.common import fresh_name, let, settled
from backframe.session import stored

#: Given names by gender and script. Each is replaced by another of its list.
GIVEN = {
    "female latin": (
        "Alice Amelia Andrea Anna Barbara Carmen Caroline Catherine Charlotte Claire Elena Elizabeth Emily Emma "
        "Eva Hannah Helen Ingrid Isabel Jennifer Jessica Julia Karen Katharina Laura Linda Lisa Lucia Maria Martha "
        "Mary Michelle Monika Nancy Nicole Olivia Patricia Petra Rachel Rebecca Sabine Sandra Sarah Sofia Sophie "
        "Susan Ursula Victoria"
    ).split(),
    "male latin": (
        "Alexander Andrew Anthony Benjamin Carlos Charles Christian Daniel David Diego Edward Felix Fernando "
        "Francois Frank George Hans Henry Jacques James Jan Javier Jean John Jorge Joseph Juan Klaus Laurent Louis "
        "Luis Lukas Mark Martin Matthew Michael Miguel Nicolas Oliver Pablo Paul Peter Philip Pierre Richard Robert "
        "Samuel Stefan Thomas William"
    ).split(),
    "female cyrillic": "Анна Анастасия Вера Дарья Екатерина Елена Ирина Ксения Людмила Мария Наталья Ольга Светлана Татьяна".split(),
    "male cyrillic": "Александр Алексей Андрей Борис Владимир Дмитрий Иван Максим Михаил Николай Олег Павел Сергей Юрий".split(),
}
#: Titles that stand before a surname.
TITLES = "Mr Mrs Ms Miss Dr Prof Herr Frau Monsieur Madame Mme Señor Señora Sr Sra Господин Госпожа".split()
#: Alphabets within which a character stays.
ALPHABETS = (
    "0123456789",
    "aeiou",
    "bcdfghjklmnpqrstvwxyz",
    "AEIOU",
    "BCDFGHJKLMNPQRSTVWXYZ",
    "аеиоуыэюя",
    "бвгджзклмнпрстфхцчшщ",
    "αεηιουω",
    "βγδζθκλμνξπρστφχψ",
    "áàâäéèêëíìîïóòôöúùûü",
)
#: First and last code point of ranges of one script. A letter that is in no alphabet becomes
#: another small one of its range, one whose capital is a single letter.
RANGES = (
    (0xDF, 0xFF), (0x100, 0x17F), (0x180, 0x24F), (0x1E00, 0x1EFF), (0x370, 0x3FF), (0x1F00, 0x1FFF), (0x400, 0x45F),
    (0x460, 0x52F), (0x560, 0x588), (0x10D0, 0x10FF), (0x2C00, 0x2C5F), (0x2C80, 0x2CFF), (0x13A0, 0x13FF),
    (0xAB70, 0xABBF), (0x10400, 0x1044F), (0x104B0, 0x104FF), (0x10CC0, 0x10CFF), (0x118C0, 0x118DF), (0x1E900, 0x1E943),
)
#: Alphabets of hexadecimal numbers.
HEXADECIMAL = ("0123456789", "abcdef", "ABCDEF")
#: Country codes of one and of two digits; all others have three.
ONE_DIGIT_CODE = "^[+][17]"
TWO_DIGIT_CODE = "^[+](?:2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
#: So many attempts keep the length of an entity; each one after them draws a surrogate longer by a character.
SHAPED = 8
#: Characters added that make a clash as good as impossible.
AMPLE = 32
_NAMES = "|".join(n for own in GIVEN.values() for n in own)
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
#: A name with what belongs to it: O'Brien, McDonald, Smith-Jones, decomposed accents; and initials before it.
_LOW = r"[\p{Ll}\p{M}]"
_HEAD = rf"\p{{Lu}}\p{{M}}*(?:['’ʼ]\p{{Lu}})?{_LOW}"
#: Groups that repeat are bounded: the engine goes a level deeper with every round of one.
_NAME = rf"{_HEAD}+(?:[\-‐'’ʼ]?{_HEAD}+){{0,8}}+"
_INITIALS = r"(?:\p{Lu}[.] ?)?(?:\p{Lu}[.] ?)?"
#: Phones with a country code in groups, national ones with a leading zero, and ten digits in groups.
_NATIONAL = r"0\d{1,4}[ .\-]\d{3,4}[ .\-]?\d{3,4}|0\d(?:[ .\-]\d{2}){4}"
_TEN = r"\d{3}[ .\-]\d{3}[ .\-]\d{4}"
#: What each type looks like, in order of precedence.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]{1,64}+@[A-Za-z0-9\-]{1,63}(?:\.[A-Za-z0-9\-]{1,63}){0,8}\.[A-Za-z]{2,24}",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "secret": r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|(?:sk|pk|ghp|gho|xox[bp])[_\-][A-Za-z0-9_\-]{16,}"
    r"|(?=[0-9]*+[a-fA-F])(?=[a-fA-F]*+[0-9])[0-9a-fA-F]{24,}+"
    r"|(?<=[=:] ?[\"'])(?=[A-Za-z_\-+/=]*+[0-9])(?=[0-9_\-+/=]*+[A-Za-z])[A-Za-z0-9_\-+/=]{12,}+)(?![A-Za-z0-9])",
    "phone": r"(?<![\d+])(?:\+\d{1,3}[ .\-]?\(?\d{2,4}\)?[ .\-]?\d{3,4}[ .\-]?\d{3,4}|\(\d{3}\) ?\d{3}[ .\-]\d{4}"
    r"|\+\d{1,3}[ .\-]?(?:\(0\)[ .\-]?)?\d{1,4}(?:[ .\-]\d{2,4}){2,5}"
    rf"|(?<!\d[ .\-])(?:{_TEN}|{_NATIONAL})(?![ .\-]\d{{4}}))(?!\d)",
    "ssn": r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])",
    "card": r"(?<![\d.])(?:\d{4}[ \-]\d{4}[ \-]\d{4}[ \-]\d{4}|\d{4}[ \-]\d{6}[ \-]\d{5}|\d{13,19})(?![\d.]\d|\d)",
    "address": rf"(?<![\d.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\d|\.\d)",
    "given": rf"(?=\p{{Lu}}\p{{Ll}})(?<!\p{{L}})(?:{_NAMES})(?= {_INITIALS}{_HEAD})",
    "surname": rf"(?={_HEAD})(?<=(?<!\p{{L}})(?:{_NAMES}|{'|'.join(TITLES)})[.]? {_INITIALS}){_NAME}",
}
ANY = "|".join(PATTERNS.values())
#: What tells the type of a match; anything else that is matched is a surname.
TELLS = {
    "email": "@",
    "address": rf"^{_OCTET}(?:\.{_OCTET}){{3}}$",
    "phone": rf"^(?:\+|\()|^(?:{_TEN}|{_NATIONAL})$",
    "ssn": r"^\d{3}-\d{2}-\d{4}$",
    "card": r"^[\d \-]+$",
    "iban": r"^[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3}",
    "given": rf"^(?:{_NAMES})$",
    "surname": rf"^{_NAME}$",
}


@dataclass(frozen=True)
class Surrogates:
    """``secret`` keys the surrogates; without it they tell nothing of what they stand for.

    ``rounds`` are the draws after which an entity takes a surrogate of ample length at once.
    """

    secret: str = "change me"
    rounds: int = 40


def kind_of(found: Column) -> Column:
    kind = None
    for name, pattern in TELLS.items():
        test = found.rlike(pattern)
        kind = F.when(test, name) if kind is None else kind.when(test, name)
    return kind.otherwise("secret")


def canonical(kind: Column, found: Column) -> Column:
    """One form for all spellings of an entity, so that it has one surrogate everywhere."""
    return (
        F.when(kind.isin("card", "ssn"), F.regexp_replace(found, "[^0-9]", ""))
        .when(kind == "phone", F.regexp_replace(found, "(?<!^)[+]|[^0-9+]", ""))
        .when(kind == "iban", F.regexp_replace(found, " ", ""))
        .when(kind == "email", F.lower(found))
        .when(kind == "surname", F.translate(F.lower(found), "’ʼ‐", "''-"))
        .otherwise(found)
    )


def byte_at(digest: Column, place: Column) -> Column:
    return F.conv(F.substring(digest, F.pmod(place, F.lit(32)) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def small_letters(first: int, last: int) -> str:
    """The small letters of a range that their capitals lead back to."""
    chars = [chr(c) for c in range(first, last + 1)]
    return "".join(
        c for c in chars if unicodedata.category(c) == "Ll" and len(c.upper()) == 1 and c.upper() != c and c.upper().lower() == c
    )


def redrawn(
    text: Column, digest: Column, fixed: int | Column = 0, ascii_only: bool = True, alphabets: tuple[str, ...] | None = None
) -> Column:
    """Each character behind the first ``fixed`` by one of its alphabet or range, drawn by the digest.

    Letters of any other script become Latin ones, so that none is left as it is. ``ascii_only``
    spares what ASCII texts do not need; given ``alphabets`` are the only ones.
    """
    known = alphabets or (ALPHABETS[:5] if ascii_only else ALPHABETS)

    def draw(char: Column, place: Column) -> Column:
        def one_of(letters: str) -> Column:
            at = F.pmod(byte_at(digest, place), F.lit(len(letters))) + 1
            return F.substring(F.lit(letters), at, F.lit(1))

        out = F.when(place < fixed, char)
        for letters in known:
            out = out.when(F.instr(F.lit(letters), char) > 0, one_of(letters))
        if ascii_only:
            return out.otherwise(char)
        out = out.when(char < F.lit("\x80"), char)
        for first, last in RANGES:
            inside = char.between(F.lit(chr(first)), F.lit(chr(last))) & char.rlike(r"^\p{L}")
            out = out.when(inside, one_of(small_letters(first, last)))
        return out.when(char.rlike(r"^\p{L}"), one_of(ALPHABETS[2])).otherwise(char)

    return F.array_join(F.transform(F.split(text, ""), draw), "")


def luhn_sum(digits: Column) -> Column:
    """Sum of the check, the last digit being the check digit."""
    def term(char: Column, place: Column) -> Column:
        d = char.cast("int")
        twice = F.pmod(F.length(digits) - place, F.lit(2)) == 0
        return F.when(twice, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)

    return F.aggregate(F.transform(F.split(digits, ""), term), F.lit(0), lambda a, x: a + x)


def code_length(phone: Column) -> Column:
    """Characters of the plus sign and the country code, 0 for a national number."""
    return (
        F.when(phone.rlike(ONE_DIGIT_CODE), 2)
        .when(phone.rlike(TWO_DIGIT_CODE), 3)
        .when(phone.startswith("+"), 4)
        .otherwise(0)
    )


def iban_rest(iban: Column) -> Column:
    """What is left of an account number by 97: its head behind its tail, letters from 10 on."""
    def add(rest: Column, char: Column) -> Column:
        digit = F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), char) - 1
        return F.pmod(rest * F.when(digit > 9, 100).otherwise(10) + digit, F.lit(97))

    turned = F.concat(iban.substr(F.lit(5), F.length(iban)), F.substring(iban, 1, 4))
    return F.aggregate(F.split(turned, ""), F.lit(0), add)


def with_check_digits(iban: Column) -> Column:
    """The number with the check digits that make its rest 1."""
    head, tail = F.substring(iban, 1, 2), iban.substr(F.lit(5), F.length(iban))
    check = 98 - iban_rest(F.concat(head, F.lit("00"), tail))
    return F.concat(head, F.lpad(check.cast("string"), 2, "0"), tail)


def surrogate(kind: Column, own: Column, attempt: Column, secret: str) -> Column:
    """Canonical surrogate of a canonical entity; the attempt varies it, late ones are longer."""
    longer = F.greatest(attempt - (SHAPED - 1), F.lit(0))
    digest = lambda what: F.sha2(F.concat_ws("\x1f", F.lit(secret), kind, what, attempt.cast("string")), 256)

    def made(seed: Column) -> Column:
        octets = [F.pmod(byte_at(seed, F.lit(i)), F.lit(223)) + 1 for i in range(4)]
        local, domain = F.substring_index(own, "@", 1), F.substring_index(own, "@", -1)
        host = F.regexp_replace(domain, r"\.[^.]+$", "")
        # The domain hangs on itself alone, so addresses of one domain stay together.
        email = F.concat(
            redrawn(F.concat(local, F.repeat(F.lit("b"), longer)), seed), F.lit("@"),
            redrawn(host, F.sha2(F.concat_ws("\x1f", F.lit(secret), F.lit("domain"), domain), 256)),
            F.regexp_extract(domain, r"\.[^.]+$", 0),
        )
        # Digits and letters alike are added by drawing on the last one.
        last = F.regexp_replace(F.substring(own, -1, 1), r"^[^0-9\p{L}]$", "b")
        room = F.concat(own, F.repeat(last, longer))
        plain = redrawn(room, seed, ascii_only=False)
        body = redrawn(room, seed, 1)
        groups = [F.substring(seed, 4 * i + 1, 4) for i in range(7)]
        checked = let(
            F.concat(body.substr(F.lit(1), F.length(body) - 1), F.lit("0")),
            lambda zero: F.concat(
                zero.substr(F.lit(1), F.length(zero) - 1), F.pmod(-luhn_sum(zero), F.lit(10)).cast("string")
            ),
        )
        return (
            F.when(kind == "email", email)
            .when((kind == "address") & (longer > 0), F.concat_ws(":", F.lit("fd00"), *groups))
            .when(kind == "address", F.concat_ws(".", *octets))
            .when(kind == "phone", redrawn(room, seed, code_length(own)))
            .when((kind == "iban") & (iban_rest(own) == 1), let(redrawn(room, seed, 2), with_check_digits))
            .when(kind == "iban", redrawn(room, seed, 2))
            .when((kind == "secret") & own.rlike("^[0-9a-fA-F]+$"), redrawn(room, seed, alphabets=HEXADECIMAL))
            .when((kind == "card") & (F.pmod(luhn_sum(own), F.lit(10)) == 0), checked)
            .when(kind == "card", body)
            .otherwise(plain)
        )

    return let(digest(own), made)


def dressed(kind: Column, found: Column, new: Column) -> Column:
    """The surrogate in the spelling of the entity: its spaces and marks, or its capitals."""
    plain = F.regexp_replace(new, "^[+]", "")
    spelled = F.aggregate(
        F.split(found, ""),
        F.struct(F.lit("").alias("out"), F.lit(1).alias("next")),
        lambda a, c: F.when(
            c.rlike("^[0-9A-Za-z]$"),
            F.struct(F.concat(a["out"], F.substring(plain, a["next"], F.lit(1))).alias("out"), (a["next"] + 1).alias("next")),
        ).otherwise(F.struct(F.concat(a["out"], c).alias("out"), a["next"].alias("next"))),
        lambda a: F.concat(a["out"], plain.substr(a["next"], F.length(plain))),
    )
    def cased(char: Column, place: Column) -> Column:
        own = F.substring(found, place + 1, F.lit(1))
        marks = char.isin("'", "-") & own.isin("’", "ʼ", "‐")
        return F.when(marks, own).when(own.rlike(r"^\p{Lu}"), F.upper(char)).otherwise(char)

    return (
        F.when(kind.isin("phone", "card", "ssn", "iban"), spelled)
        .when(kind == "surname", F.array_join(F.transform(F.split(new, ""), cased), ""))
        .otherwise(new)
    )


def other_given(found: Column, secret: str) -> Column:
    """Another name of the same list: a turn of the list by a keyed step, so names stay distinct."""
    out = None
    for group, names in GIVEN.items():
        own = F.array(*[F.lit(n) for n in names])
        seed = F.sha2(F.lit(f"{secret}\x1f{group}"), 256)
        step = F.pmod(F.conv(F.substring(seed, 1, 8), 16, 10).cast("long"), F.lit(len(names) - 1)) + 1
        place = F.pmod(F.array_position(own, found) - 1 + step, F.lit(len(names))).cast("int")
        test = F.array_contains(own, found)
        new = F.get(own, place)
        out = F.when(test, new) if out is None else out.when(test, new)
    return out


def entities_of(docs: DataFrame, name: str, text: str) -> DataFrame:
    """The documents with an array of (found, kind, own): matches in order, own being canonical."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    matched = settled(docs, name, F.regexp_extract_all(body, F.lit(ANY), F.lit(0)).alias("found"))
    typed = F.transform(
        F.col(name)["found"],
        lambda m: let(
            kind_of(m), lambda k: F.struct(m.alias("found"), k.alias("kind"), canonical(k, m).alias("own"))
        ),
    )
    return settled(matched, name, typed.alias("entities"))


def assign(entities: DataFrame, how: Surrogates) -> DataFrame:
    """(kind, own, attempt, new) of distinct entities; no two of a kind share a surrogate.

    Nor is a surrogate an entity that occurs itself. Of those that clash, the least keeps its
    surrogate, the others draw again, round by round; equal draws meet by a join on the draw.
    Where the surrogates of an entity's length run short, longer ones are drawn, after ``rounds``
    at once ones of ample length, so it always ends.
    """
    new = lambda attempt: surrogate(F.col("kind"), F.col("own"), attempt, how.secret)
    entities = stored(entities, "entities")
    drawn = stored(
        entities.withColumn("attempt", F.lit(0)).withColumn("new", new(F.col("attempt"))), "surrogates"
    )
    following = F.col("attempt") + 1
    following = F.greatest(following, F.when(following >= how.rounds, SHAPED + AMPLE))
    while True:
        shared = drawn.groupBy("kind", "new").agg(F.min("own").alias("keeps"), F.count("*").alias("n")).where("n > 1")
        taken = entities.select("kind", F.col("own").alias("new"), F.lit(True).alias("real"))
        losing = (
            drawn.join(shared.select("kind", "new", "keeps"), ["kind", "new"], "left")
            .join(taken, ["kind", "new"], "left")
            .where("own <> keeps OR real")
            .select("kind", "own", F.lit(1).alias("again"))
        )
        if losing.isEmpty():
            return drawn
        retried = drawn.join(losing, ["kind", "own"], "left")
        kept = retried.where("again IS NULL").drop("again")
        redone = retried.where("again = 1").select("kind", "own", following.alias("attempt"))
        drawn = stored(kept.unionByName(redone.withColumn("new", new(F.col("attempt")))), "surrogates")


def replace_entities(docs: DataFrame, how: Surrogates = Surrogates(), text: str = "text") -> DataFrame:
    """The documents with their text rewritten, and a column ``n_entities``.

    An entity has one surrogate wherever it occurs, in whatever spelling; surrogates of distinct
    entities of a kind differ. Text between entities stays as it is. Surrogates are worked out
    in place from the key and the entity; only those of entities that clashed, which the table of
    distinct entities tells, are fetched by a join, on the hash of the text, as the entities of
    a document hang on nothing else. A null text stays null. Repeated rows are rewritten alike. Columns
    of other names are kept; ``n_entities`` of the input is replaced.
    """
    name = fresh_name(docs, "found_entities")
    hashed, overrides = fresh_name(docs, "text_hash"), fresh_name(docs, "overrides")
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    found = entities_of(docs, name, text)
    each = lambda *more: (
        found.select(*more, F.explode(F.col(name)["entities"]).alias("e")).where("e.kind <> 'given'")
        .select(*[F.col(c) if isinstance(c, str) else F.col("hashed") for c in more], "e.kind", "e.own").distinct()
    )
    assigned = assign(each(), how)
    retried = assigned.where("attempt > 0")
    if retried.isEmpty():
        found = found.withColumn(overrides, F.lit(None).cast("map<string,string>"))
    else:
        changed = (
            each(F.xxhash64(body).alias("hashed"))
            .join(retried, ["kind", "own"])
            .groupBy("hashed")
            .agg(F.map_from_entries(F.collect_list(F.struct(F.concat_ws(":", "kind", "own"), "new"))).alias(overrides))
            .withColumnRenamed("hashed", hashed)
        )
        found = found.withColumn(hashed, F.xxhash64(body)).join(changed, hashed, "left").drop(hashed)

    def replaced(e: Column) -> Column:
        fresh = surrogate(e["kind"], e["own"], F.lit(0), how.secret)
        held = F.element_at(F.col(overrides), F.concat_ws(":", e["kind"], e["own"]))
        known = F.when(F.col(overrides).isNotNull(), held)
        return F.when(e["kind"] == "given", other_given(e["found"], how.secret)).otherwise(
            let(F.coalesce(known, fresh), lambda new: dressed(e["kind"], e["found"], new))
        )

    news = F.transform(F.col(name)["entities"], replaced)
    gaps = F.split(body, ANY, -1)
    rewritten = F.when(F.size(F.col(name)["entities"]) == 0, F.col(f"`{text}`")).otherwise(
        F.array_join(F.flatten(F.zip_with(gaps, news, lambda g, n: F.array(g, F.coalesce(n, F.lit(""))))), "")
    )
    kept = [rewritten.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns if c != "n_entities"]
    return found.select(*kept, F.size(F.col(name)["entities"]).cast("long").alias("n_entities"))
