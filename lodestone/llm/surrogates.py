"""Replace personal data by keyed surrogates of the same type, gender, script and format.

Entities are found by patterns (e-mail addresses, telephone numbers, payment cards that pass their
check digit, account numbers (IBAN) that pass theirs, IPv4 and IPv6 addresses, secrets, names behind a title). Every distinct entity of the
corpus gets one surrogate from a keyed hash, so all its mentions agree (coreference), whatever
their format: a mention's own separators and letter case are kept. Surrogates are then checked:
one that is also an original, or that two entities drew, is drawn again with the next counter until
all are distinct, given names too. Later attempts draw from more values (further syllables, letters
or digits), so small spaces of names, initials, addresses, numbers or secrets never block; cards and
IP addresses keep their length, and are drawn again as long as values are free. Only SQL functions run here; nothing is collected or broadcast by hand.

Names: up to six words behind a title, with inner capitals, hyphens, apostrophes, initials and
particles (``von``, ``de``), in any case. Every word is an entity of its own, the last one the
family name, so that a person met by family name alone keeps the surrogate; particles stay. A full
name found so is also replaced where the same document repeats it without the title (if several
titles stand before it, as with the first of them by gender). Given names come from lists by gender
(of the title) and script, family names are built from syllables of their script.

Defined cases: a null or empty text stays; repeated rows and null ids are handled row by row; IPv6 addresses are written out in full; equal
rows give equal rows; numbers that fail the check digit, and addresses with parts above 255, are no
entities and stay, as do secrets without letter or digit (masks such as ``"********"``); an empty table gives no rows; further columns, whatever their names, are
carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.llm.carry import packed, unpacked
from lodestone.session import cut_lineage

_GAP = r"[^\p{L}\p{N}+]{1,8}"
# Java matches a repeated group by recursion, so every repeat of a group is bounded; runs of one
# class are not, but may only begin where the run does.
_LOCAL = r"[\p{L}\p{N}._%+\-]"
_LABEL = r"[\p{L}\p{N}\-]{1,63}"
EMAIL = rf"(?<!{_LOCAL}){_LOCAL}++@{_LABEL}(?:\.{_LABEL}){{0,30}}\.\p{{L}}{{2,63}}"
IBAN = (r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?"
        r"(?![\p{L}\p{N}])")
#: What may stand between two digits of a telephone number.
_SEP = r"(?:[ \u00a0./\-–]|[ \u00a0]?\(|\)[ \u00a0./\-]?)"
_DATE = (r"(?:\d{1,2}[./\-]\d{1,2}[./\-](?:(?:19|20)\d{2}(?!\d)|\d{2}(?![./\-]?\d))"
         r"|\d{1,2} \d{1,2} (?:19|20)\d{2}(?!\d))")
PHONE = (rf"\+\d{{1,3}}{_GAP}\d{{3}}{_GAP}\d{{3}}{_GAP}\d{{4}}(?!\d)"
         r"|(?<![\d.])\(?\d{3}\)?[ .\-]\d{3}[ .\-]\d{4}(?!\d)"
         r"|\+\d{10,14}(?!\d)"
         rf"|\+[1-9]\d{{0,2}}(?:{_SEP}?\d){{6,12}}(?!\d)"
         rf"|(?<![\p{{L}}\p{{N}}.,+/\-])00[1-9]\d{{0,2}}{_SEP}(?:{_SEP}?\d){{6,12}}(?!\d)"
         rf"|(?<![\p{{L}}\p{{N}}.,+/\-])(?!{_DATE})\(?0[1-9]\d{{0,4}}{_SEP}\d"
         rf"(?:{_SEP}?\d){{5,10}}(?!{_SEP}?\d)")
#: Country codes (fixed values); all others have three digits.
COUNTRY = (r"1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]")
CARD = (r"(?<![\d.])(?:\d{4}[ \-]\d{6}[ \-]\d{4,5}"
        r"|\d{4}[ \-]?\d{4}[ \-]?\d{4}[ \-]?\d{1,7})(?!\d)")
IP = r"(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\.?\d)"
_LOOSE = r"[^\p{L}\p{N}\"=:]{0,8}"
_SIX = r"[0-9A-Fa-f]{1,4}"
IP6 = (rf"(?<![\p{{L}}\p{{N}}:.])(?:{_SIX}(?::{_SIX}){{7}}"
       rf"|[0-9A-Fa-f]{{4}}(?::{_SIX}){{0,5}}::{_SIX}(?::{_SIX}){{0,5}}"
       rf"|[0-9A-Fa-f]{{4}}(?::{_SIX}){{1,6}}::)(?![\p{{L}}\p{{N}}:])")
_KEYWORD = (r"(?i:token|secret|password|passwort|passwd|pwd|mot de passe|contraseña"
            r"|(?:api|access|private)[ _\-]?key)")
_BARE = r"[^\s\"',;<>()]{7,}[\p{L}\p{N}]"
#: Keys known by how they begin (fixed values).
_PREFIX = r"(?:sk-|AKIA|gh[pousr]_|xox[abprs]-|AIza|glpat-)"
SECRET = (rf"{_KEYWORD}[\"']?{_LOOSE}[=:]{_LOOSE}\"[^\"\s]{{8,}}\""
          rf"|{_KEYWORD}[\"']?[ \t]*[=:]{{1,2}}>?[ \t]*'[^'\s]{{8,}}'"
          rf"|{_KEYWORD}={_BARE}"
          rf"|{_KEYWORD}[ \t]*[=:]{{1,2}}>?[ \t]*(?=[^\s\"',;<>()]*\d){_BARE}"
          rf"|(?<![\p{{L}}\p{{N}}]){_PREFIX}[A-Za-z0-9_\-]{{15,}}[A-Za-z0-9]")
#: Titles by gender (fixed values).
MALE = r"Mr\.|MR\.|Herr|HERR|Sr\.|SR\.|Monsieur|MONSIEUR|г-н|Г-н|Г-Н"
FEMALE = (r"Mrs\.|MRS\.|Ms\.|MS\.|Miss|MISS|Frau|FRAU|Sra\.|SRA\.|Mme|MME|Madame|MADAME"
          r"|г-жа|Г-жа|Г-ЖА")
TITLE = rf"(?:{MALE}|{FEMALE}) "
#: Words of a name that stay (fixed values).
PARTICLE = (r"(?i:von|vom|van|der|den|de|del|della|di|da|dos|das|do|du|des|la|las|los|le|el|al|bin"
            r"|ben|ibn|zu|zur|zum|ter|ten)")
_INITIAL = r"\p{Lu}\.(?:-?\p{Lu}\.){0,5}"
_WORD = (r"\p{Lu}[\p{L}\p{M}]*"
         r"(?:-[\p{L}\p{M}]+|['’](?![sS](?![\p{L}\p{M}]))[\p{L}\p{M}]+){0,5}")
_NAME_WORD = rf"(?:{PARTICLE} ){{0,4}}(?:{_INITIAL}|{_WORD})"
NAME = rf"(?<!\p{{L}}){TITLE}{_NAME_WORD}(?: {_NAME_WORD}){{0,5}}"
PATTERN = "|".join((SECRET, EMAIL, IP6, IP, IBAN, PHONE, CARD, NAME))
#: Any entity holds one of these; other texts are not searched.
HINT = rf"[0-9@\"]|{_KEYWORD}|{_PREFIX}|{TITLE}"
#: Surrogate names (fixed values) by gender and script.
GIVEN = {
    "m": ("Adam", "Bruno", "Conrad", "Dario", "Emil", "Felix", "Gustav", "Hugo", "Ivo", "Julian",
          "Kilian", "Leon", "Martin", "Noel", "Oscar", "Paul"),
    "f": ("Ada", "Bianca", "Clara", "Diana", "Elsa", "Flora", "Greta", "Hanna", "Irene", "Julia",
          "Karla", "Laura", "Maria", "Nora", "Olga", "Paula"),
    "mc": ("Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Кирилл", "Лев", "Марк",
           "Никита", "Олег", "Павел", "Роман", "Семён", "Фёдор"),
    "mg": ("Αλέξης", "Βασίλης", "Γιάννης", "Δημήτρης", "Ηλίας", "Θωμάς", "Κώστας", "Λευτέρης",
           "Μάριος", "Νίκος", "Ορέστης", "Παύλος", "Σπύρος", "Τάσος", "Φίλιππος", "Χρήστος"),
    "fg": ("Άννα", "Βασιλική", "Γεωργία", "Δήμητρα", "Ελένη", "Ζωή", "Ηρώ", "Ιωάννα", "Κατερίνα",
           "Λυδία", "Μαρία", "Νίκη", "Όλγα", "Ρένα", "Σοφία", "Χριστίνα"),
    "fc": ("Анна", "Вера", "Галина", "Дарья", "Елена", "Жанна", "Зоя", "Ирина", "Клара", "Лидия",
           "Мария", "Нина", "Ольга", "Полина", "Софья", "Юлия"),
}
SYLLABLES = {
    "latin": ("ba", "den", "fil", "gor", "han", "jas", "kel", "lor", "mar", "nel", "pol", "ros",
              "sal", "tor", "ven", "wil"),
    "cyrillic": ("ба", "ден", "фил", "гор", "хан", "яс", "кел", "лор", "мар", "нел", "пол", "рос",
                 "сал", "тор", "вен", "вил"),
    "greek": ("βα", "δεν", "φιλ", "γορ", "χαν", "ιασ", "κελ", "λορ", "μαρ", "νελ", "πολ", "ροσ",
              "σαλ", "τορ", "βεν", "ζιλ"),
}
INITIALS = {"latin": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "cyrillic": "АБВГДЕЖЗИКЛМНОПРСТУФХЭЮЯ",
            "greek": "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ"}
#: Endings of the keys of GIVEN by script.
ENDING = {"latin": "", "cyrillic": "c", "greek": "g"}


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _check_sum(digits: Column) -> Column:
    """The check sum of a number: a multiple of 10 for payment cards."""
    places = F.sequence(F.lit(1), F.length(digits))
    return F.aggregate(places, F.lit(0), lambda total, i: total + _luhn(
        F.substr(digits, F.length(digits) - i + 1, F.lit(1)).cast("int"), i))


def _luhn(digit: Column, place: Column) -> Column:
    twice = digit * 2
    return F.when(place % 2 == 1, digit).otherwise(twice - F.when(twice > 9, 9).otherwise(0))


def _mod97(number: Column) -> Column:
    """The remainder by 97 of a number with letters (A is 10, ..., Z is 35), for account numbers."""
    return F.aggregate(F.split(number, ""), F.lit(0), lambda total, c: F.when(
        c == "", total).when(c.rlike("[0-9]"), (total * 10 + c.cast("int")) % 97).otherwise(
            (total * 100 + F.ascii(c) - 55) % 97))


def _account(mention: Column) -> Column:
    return F.replace(mention, F.lit(" "), F.lit(""))


def _is_account(mention: Column) -> Column:
    plain = _account(mention)
    return F.length(plain).between(15, 34) & (_mod97(F.concat(
        F.substr(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))) == 1)


def _kind(mention: Column) -> Column:
    """The type of a match, or null if a closer look rejects it."""
    octets = F.transform(F.split(mention, r"\."), lambda x: x.cast("int"))
    whole = rf"^(?:{PHONE})$"
    return (F.when(mention.rlike(rf"^(?:{SECRET})$"), F.when(
                _secret(mention).rlike(r"[\p{L}\p{N}]"), "secret"))
            .when(mention.contains("@"), "email")
            .when(mention.rlike(rf"^(?:{IP6})$"), F.when(mention.rlike("[0-9]") & (
                F.size(F.filter(F.split(mention, ":"), lambda x: x != "")) <= 8), "ip6"))
            .when(mention.rlike(r"^\d+\.\d+\.\d+\.\d+$"),
                  F.when(F.forall(octets, lambda x: x <= 255), "ip"))
            .when(mention.rlike(rf"^(?:{IBAN})$"), F.when(_is_account(mention), "iban"))
            .when(mention.rlike(whole), "phone")
            .when(mention.rlike(r"^[\d \-]+$"), F.when(
                (F.length(_digits(mention)) >= 13) & (_check_sum(_digits(mention)) % 10 == 0),
                "card"))
            .otherwise("name"))


def _secret(mention: Column) -> Column:
    """What is secret in a match: without keyword, quotes and known beginning."""
    inner = (F.when(mention.endswith("\""), F.regexp_extract(mention, "\"([^\"]+)\"$", 1))
             .when(mention.endswith("'"), F.regexp_extract(mention, "'([^']+)'$", 1))
             .when(mention.rlike(rf"^{_PREFIX}"), mention)
             .otherwise(F.regexp_extract(mention, r"[=:]{1,2}>?[ \t]*([^\s\"',;<>()]+)$", 1)))
    return F.regexp_replace(inner, rf"^{_PREFIX}", "")


def _national(mention: Column) -> Column:
    """The digits without country code and leading zero: the same number with and without its
    country is one entity."""
    digits = F.regexp_replace(_digits(mention), "^00", "")
    abroad = mention.startswith("+") | mention.startswith("00")
    return F.regexp_replace(F.when(abroad, F.regexp_replace(
        digits, rf"^(?:{COUNTRY}|\d{{3}})", "")).otherwise(digits), "^0", "")


def _written_out(address: Column) -> Column:
    """An IPv6 address as eight groups of four lower-case digits."""
    halves = F.split(F.lower(address), "::")
    first, rest = [F.filter(F.split(F.coalesce(F.get(halves, F.lit(k)), F.lit("")), ":"),
                            lambda x: x != "") for k in (0, 1)]
    zeros = F.array_repeat(F.lit("0"), 8 - F.size(first) - F.size(rest))
    return F.array_join(F.transform(F.concat(first, zeros, rest),
                                    lambda x: F.lpad(x, 4, "0")), ":")


def _bare(name: Column) -> Column:
    """A name without its title."""
    return F.regexp_replace(name, f"^{TITLE}", "")


def _parts(kind: Column, mention: Column) -> Column:
    """The entities of a mention, as (type, canonical form), in order; null for particles."""
    words = F.split(_bare(mention), " ")
    gender = F.when(mention.rlike(rf"^(?:{MALE}) "), "m").otherwise("f")

    def entity(kind: Column, text: Column) -> Column:
        return F.struct(kind.alias("type"), text.alias("canon"))

    def part(word: Column, i: Column) -> Column:
        script = (F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic")
                  .when(word.rlike(r"\p{IsGreek}"), "greek").otherwise("latin"))
        group = F.concat(F.lit("given-"), gender, F.when(script == "cyrillic", "c").when(
            script == "greek", "g").otherwise(""))
        last = i == F.size(words) - 1
        return (F.when(word.rlike(rf"^{_INITIAL}$"), entity(
                    F.concat(F.lit("initial-"), script), F.regexp_replace(word, r"\.$", "")))
                .when(last, entity(F.concat(F.lit("family-"), script), F.lower(word)))
                .when(~word.rlike(rf"^{PARTICLE}$"), entity(group, F.lower(word))))

    plain = (F.when(kind == "email", F.lower(mention)).when(kind == "secret", _secret(mention))
             .when(kind == "ip6", _written_out(mention)).when(kind == "ip", mention)
             .when(kind == "iban", _account(mention)).when(kind == "phone", _national(mention))
             .otherwise(_digits(mention)))
    return F.when(kind == "name", F.transform(words, part)).otherwise(F.array(entity(kind, plain)))


def _stream(key: str, *parts: Column) -> Column:
    """Hexadecimal digits from a keyed hash, 256 of them."""
    seed = F.concat_ws("\x1f", F.lit(key), *parts)
    return F.concat(*[F.sha2(F.concat(F.lit(f"{k}\x1f"), seed), 512) for k in range(2)])


def _shaped(text: Column, stream: Column, letters: str) -> Column:
    """``text`` with each digit and letter replaced by one drawn for its place."""
    low, high = letters.lower(), letters.upper()

    def one(c: Column, i: Column) -> Column:
        drawn = F.substr(stream, i % 255 + 1, F.lit(2))
        value = F.conv(drawn, 16, 10).cast("int")
        return (F.when(c.rlike(r"\p{N}"), F.substr(F.lit("0123456789"), value % 10 + 1, F.lit(1)))
                .when(c.rlike(r"\p{Lu}"), F.substr(
                    F.lit(high), value % len(high) + 1, F.lit(1)))
                .when(c.rlike(r"\p{L}"), F.substr(F.lit(low), value % len(low) + 1, F.lit(1)))
                .otherwise(c))

    return F.array_join(F.transform(F.split(text, ""), one), "")


def _surrogate(key: str, kind: Column, canon: Column, attempt: Column) -> Column:
    """The surrogate of an entity in canonical form; later attempts draw from more values."""
    stream = _stream(key, kind, canon, attempt.cast("string"))
    # Bound to a variable, so that the hashes are made once.
    return F.get(F.transform(F.array(stream), lambda s: _drawn(key, kind, canon, attempt, s)),
                 F.lit(0))


def _drawn(key: str, kind: Column, canon: Column, attempt: Column, stream: Column) -> Column:
    def value(k: int) -> Column:
        return F.conv(F.substring(stream, 1 + 4 * k, 4), 16, 10).cast("int")

    def pieces(of: list[str] | tuple[str, ...], number: Column, glue: str = "") -> Column:
        drawn = F.transform(F.sequence(F.lit(1), number), lambda i: F.element_at(
            F.array(*map(F.lit, of)), F.conv(F.substr(stream, (i * 2 + 7) % 255 + 1, F.lit(2)),
                                             16, 10).cast("int") % len(of) + 1))
        return F.when(number > 0, F.array_join(drawn, glue)).otherwise("")

    digits = F.regexp_replace(stream, "[a-f]", "")
    size = F.length(canon)
    more = F.greatest(attempt - 3, F.lit(0))
    phone = F.concat((value(0) % 8 + 2).cast("string"),
                     F.substr(digits, F.lit(1), size - 1 + more))
    body = F.concat(F.substring(canon, 1, 1), F.substr(digits, F.lit(1), size - 2))
    last = (10 - _check_sum(F.concat(body, F.lit("0"))) % 10) % 10
    address = F.concat_ws(".", *[((value(k) % 254) + 1).cast("string") for k in range(4)])
    at = F.instr(canon, "@")
    domain = F.substr(canon, at + 1, size)
    top = F.regexp_extract(domain, r"(\.[^.]+)$", 1)
    host = F.substr(domain, F.lit(1), F.length(domain) - F.length(top))
    letters = "abcdefghijklmnopqrstuvwxyz"
    email = F.concat(
        _shaped(F.substr(canon, F.lit(1), at - 1), stream, letters), pieces(list(letters), more),
        F.lit("@"), _shaped(host, _stream(key, F.lit("domain"), domain), letters), top)
    groups = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(7)), lambda i: F.substr(
        stream, i * 4 + 1, F.lit(4))), ":")
    hexadecimal = canon.rlike("^[0-9a-fA-F]+$")
    secret = F.concat(
        F.when(hexadecimal, _shaped(canon, stream, "abcdef")).otherwise(
            _shaped(canon, stream, letters)), pieces(list("abcdef"), more))
    country = F.substring(canon, 1, 2)
    number = _shaped(F.substr(canon, F.lit(5), size), stream, letters)
    proof = F.lpad((98 - _mod97(F.concat(number, country, F.lit("00")))).cast("string"), 2, "0")
    out = (F.when(kind == "email", email).when(kind == "phone", phone)
           .when(kind == "iban", F.concat(country, proof, number))
           .when(kind == "card", F.concat(body, last.cast("string"))).when(kind == "ip", address)
           .when(kind == "ip6", F.concat(F.lit("2"), F.substring(stream, 1, 3), F.lit(":"), groups))
           .when(kind == "secret", secret))
    for group, names in GIVEN.items():
        pick = F.element_at(F.array(*map(F.lit, names)), value(0) % len(names) + 1)
        parts = SYLLABLES[next(n for n, e in ENDING.items() if group[1:] == e)]
        out = out.when(kind == f"given-{group}", F.when(attempt < 2, pick).otherwise(
            F.concat(pick, F.lit("-"), F.initcap(pieces(parts, attempt)))))
    for script, alphabet in INITIALS.items():
        out = out.when(kind == f"initial-{script}", pieces(list(alphabet), attempt + 1, "."))
    for script, parts in SYLLABLES.items():
        out = out.when(kind == f"family-{script}", F.initcap(pieces(parts, attempt + 3)))
    return out


def _formatted(kind: Column, mention: Column, surrogates: Column) -> Column:
    """The mention with its entities' surrogates (by place), in the mention's own format."""
    first = F.try_element_at(surrogates, F.lit(0))
    country = F.length(_digits(mention)) - F.length(_national(mention))
    number = F.when(kind == "phone", F.concat(
        F.substr(_digits(mention), F.lit(1), country), first)).otherwise(first)
    digit = F.transform(F.split(mention, ""), lambda c, i: F.when(
        c.rlike("[0-9]"), F.substr(number, F.length(_digits(F.substr(
            mention, F.lit(1), i + 1))), F.lit(1))).otherwise(c))
    spaced = F.array_join(F.transform(F.split(mention, ""), lambda c, i: F.when(
        c == " ", c).otherwise(F.substr(first, F.length(_account(F.substr(
            mention, F.lit(1), i + 1))), F.lit(1)))), "")
    # Digits that a widened surrogate has beyond the mention's.
    longer = F.substr(number, F.length(_digits(mention)) + 1, F.length(number))
    title = F.regexp_extract(mention, f"^({TITLE})", 1)
    quote = F.regexp_extract(mention, "([\"'])$", 1)
    lead = F.length(mention) - F.length(_secret(mention)) - F.length(quote)
    quoted = F.concat(F.substr(mention, F.lit(1), lead), first, quote)

    def word(old: Column, i: Column) -> Column:
        new = F.try_element_at(surrogates, i)
        dotted = F.when(old.endswith("."), F.concat(new, F.lit("."))).otherwise(new)
        return F.coalesce(F.when((F.length(old) > 1) & _upper(old), F.upper(dotted))
                          .otherwise(dotted), old)

    return (F.when(kind.isin("email", "ip6"), F.when(_upper(mention), F.upper(first)).otherwise(first))
            .when(kind.isin("phone", "card"), F.concat(F.array_join(digit, ""), longer))
            .when(kind == "secret", quoted).when(kind == "ip", first).when(kind == "iban", spaced)
            .otherwise(F.concat(title, F.array_join(F.transform(
                F.split(_bare(mention), " "), word), " "))))


def _upper(c: Column) -> Column:
    return (c == F.upper(c)) & (c != F.lower(c))


def _same(kind: Column, text: Column) -> Column:
    """Names are the same in any case."""
    return F.when(kind.rlike("^(given|family|initial)"), F.lower(text)).otherwise(text)


def entity_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """``type, canon, surrogate`` for distinct entities (``type, canon``), all surrogates distinct
    and none of them an original."""
    now = cut_lineage(entities.select("type", "canon").distinct()
                      .withColumn("attempt", F.lit(0)))
    same = _same(F.col("type"), F.col("surrogate"))
    originals = now.select("type", _same(F.col("type"), F.col("canon")).alias("_same")).distinct(
        ).withColumn("taken", F.lit(True))
    while True:
        drawn = now.withColumn("surrogate", _surrogate(key, F.col("type"), F.col("canon"),
                                                       F.col("attempt"))).withColumn("_same", same)
        nth = F.row_number().over(Window.partitionBy("type", "_same")
                                  .orderBy("attempt", "canon"))
        clash = F.col("taken").isNotNull() | (nth > 1)
        checked = cut_lineage(
            drawn.join(originals, ["type", "_same"], "left")
            .withColumn("clash", clash))
        if not checked.filter("clash").limit(1).count():
            return checked.select("type", "canon", "surrogate")
        now = checked.select("type", "canon", (F.col("attempt") + F.col("clash").cast("int"))
                             .alias("attempt"))


def _pattern(text: Column) -> Column:
    """``PATTERN``, and the full names that the text holds behind a title."""
    names = F.array_distinct(F.transform(F.filter(
        F.regexp_extract_all(text, F.lit(f"({NAME})"), F.lit(1)),
        lambda x: _bare(x).contains(" ")), lambda x: F.lower(_bare(x))))
    # The longest first, so that no name hides a longer one that begins with it.
    ranked = F.array_sort(F.transform(names, lambda x: F.struct(-F.length(x), x.alias("n"))))
    either = F.array_join(F.transform(ranked, lambda x: F.concat(
        F.lit(r"\Q"), x["n"], F.lit(r"\E"))), "|")
    more = F.concat(F.lit(rf"{PATTERN}|(?<![\p{{L}}\-'’])(?=\p{{Lu}}|{PARTICLE} )(?iu:"), either,
                    F.lit(r")(?!\p{L}|-\p{L})"))
    return F.when(text.rlike(TITLE) & (F.size(names) > 0), more).otherwise(F.lit(PATTERN))


def with_surrogates(docs: DataFrame, key: str = "lodestone", count: str | None = None) -> DataFrame:
    """``docs`` with the entities of ``text`` replaced; ``count`` names a column for their number.

    ``n_chars``, where present, is the new length.
    """
    columns, docs = docs.columns, packed(docs)
    hinted = F.coalesce(F.col("text").rlike(HINT), F.lit(False))
    keyed = (docs.filter(hinted).withColumn("_k", F.xxhash64("doc_id", "text"))
             .withColumn("_pattern", _pattern(F.col("text"))))
    found = F.regexp_extract_all("text", F.concat(F.lit("("), "_pattern", F.lit(")")), F.lit(1))
    mentions = (keyed.select("_k", F.posexplode(found).alias("_pos", "_mention"))
                .withColumn("_type", _kind(F.col("_mention"))).filter("_type IS NOT NULL")
                .groupBy("_k", "_pos", "_mention", "_type").agg(F.lit(1).alias("_one")))
    mentions = cut_lineage(mentions.drop("_one"))
    name = F.lower(_bare(F.col("_mention"))).alias("_name")
    titled = F.col("_mention").rlike(f"^{TITLE}")
    # A name without title is read like the first titled one of its document.
    told_by = (mentions.filter((F.col("_type") == "name") & titled & _bare(
        F.col("_mention")).contains(" ")).groupBy("_k", name)
        .agg(F.max(F.regexp_extract("_mention", f"^({TITLE})", 1)).alias("_title")))
    plain = (F.col("_type") == "name") & ~titled
    read = (mentions.filter(plain).select("*", name).join(told_by, ["_k", "_name"])
            .select(*mentions.columns, F.concat("_title", "_mention").alias("_read"))
            .unionByName(mentions.filter(~plain).withColumn("_read", F.col("_mention"))))
    parts = cut_lineage(read.select(
        "_k", "_pos", "_mention", "_type",
        F.posexplode(_parts(F.col("_type"), F.col("_read"))).alias("_part", "_e"))
        .filter("_e IS NOT NULL")
        .select("_k", "_pos", "_mention", "_type", "_part", "_e.type", "_e.canon"))
    known = entity_surrogates(parts, key)
    told = (parts.join(known, ["type", "canon"])
            .groupBy("_k", "_pos", "_mention", "_type")
            .agg(F.map_from_entries(F.collect_list(F.struct("_part", "surrogate"))).alias("_s"))
            .select("_k", "_pos", _formatted(F.col("_type"), F.col("_mention"),
                                             F.col("_s")).alias("_new"))
            .groupBy("_k").agg(F.map_from_entries(F.collect_list(F.struct("_pos", "_new")))
                               .alias("_parts")))
    between = F.split("text", F.col("_pattern"), -1)
    rebuilt = F.array_join(F.transform(between, lambda s, i: F.concat(s, F.coalesce(
        F.try_element_at(F.col("_parts"), i),
        F.get(F.col("_found"), i), F.lit("")))), "")
    changed = (keyed.join(told, "_k", "left").withColumn("_found", found)
               .withColumn("text", F.when(F.col("_parts").isNull(), F.col("text"))
                           .otherwise(rebuilt))
               .withColumn("_n", F.coalesce(F.size(F.map_keys("_parts")), F.lit(0))))
    both = (changed.select(*docs.columns, F.col("_n").cast("long").alias("_n"))
            .unionByName(docs.filter(~hinted).select("*", F.lit(0).cast("long").alias("_n"))))
    if "n_chars" in docs.columns:
        both = both.withColumn("n_chars", F.when(F.col("_n") == 0, F.col("n_chars")).otherwise(
            F.length("text")).cast(docs.schema["n_chars"].dataType))
    return unpacked(both, columns, *([F.col("_n").alias(count)] if count else []))
