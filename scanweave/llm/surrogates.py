"""Personal data: detected entities get keyed replacements of the same type and form."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from scanweave.llm.tables import landed

# How entities look. The alternatives are tried in this order at each place.
EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)+"
IP = r"(?<![\p{N}.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(?!\p{N}|\.[0-9])"
# With a country code (a first group of one digit needs five digits after it), behind a trunk 0 or 00 (9 to 14 digits, no
# date, no card), and the American forms.
_NOT_IP = r"(?![0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\p{N}))"
PHONE = (
    r"(?<![\p{N}+])(?:\+[1-9][0-9]{0,2}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?(?:[0-9]{2,4}|[0-9](?=(?:[ .-]?[0-9]){5}))(?:[ .-]?" + _NOT_IP + r"[0-9]{2,4}){1,5}"
    r"|(?<![.,:/-])(?![0-9]{4}(?:[ -][0-9]{4}){3}(?!\p{N}))(?![0-3][0-9][./-][01][0-9][./-](?:19|20)[0-9]{2}(?!\p{N}))"
    r"(?=(?:[ /.-]?[0-9]){9,14}(?!\p{N}))0{1,2}[1-9][0-9]{0,4}(?:[ /.-]" + _NOT_IP + r"[0-9]{2,8}){1,4}"
    r"|\([0-9]{3}\)[ .-]?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}|[2-9][0-9]{2} [0-9]{3} [0-9]{4})(?!\p{N})"
)
CARD = r"(?<![\p{N}.])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3})(?!\p{N})"
SSN = r"(?<![\p{N}-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\p{N}-])"
# Forms of address, by gender (n: either); the name behind one, or behind several, is the entity.
TITLES = {
    "m": ("Mr", "Herr", "Monsieur", "Señor", "Signor", "Господин"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Signora", "Госпожа"),
    "n": ("Dr", "Prof", "Doctor", "Professor", "Доктор", "Профессор"),
}
# Capital first, two letters or more; hyphens and apostrophes stand before a further capital.
WORD = r"\p{Lu}(?:[\p{L}\p{M}]|['’-](?=\p{Lu}))++"
PARTICLES = r"(?:von|van|der|den|de|del|della|la|le|di|da|du|dos|ten|zu|bin|al)"
_TITLE = "(?:" + "|".join(t for titles in TITLES.values() for t in titles) + ")"
NAME = (
    rf"(?=\p{{Lu}})(?<=(?<!\p{{L}}){_TITLE}\.? )(?!{_TITLE}(?:\.|(?!\p{{L}})))"
    rf"(?:\p{{Lu}}\. ){{0,2}}{WORD}(?:(?: {PARTICLES}){{0,2}}(?: \p{{Lu}}\.(?= \p{{Lu}}))? {WORD}){{0,3}}"
)
ENTITY = "|".join(f"(?:{p})" for p in (EMAIL, IP, PHONE, CARD, SSN, NAME))
# Put around entities while a text is taken apart; a text that holds it itself is scanned twice instead.
_MARK = "\uffff"
TYPES = ("email", "ip", "phone", "card", "ssn", "name")
GIVEN = {
    ("m", "latin"): ("Adam", "Bruno", "Conrad", "David", "Emil", "Felix", "Gregor", "Hugo", "Ivan", "Jonas", "Karl", "Leon"),
    ("f", "latin"): ("Alma", "Berta", "Clara", "Diana", "Emma", "Flora", "Greta", "Helena", "Irma", "Julia", "Karla", "Lea"),
    ("n", "latin"): ("Alex", "Andrea", "Chris", "Dominique", "Jules", "Kim", "Luca", "Maxime", "Nikola", "Robin", "Sascha", "Toni"),
    ("m", "cyrillic"): ("Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Захар", "Игорь"),
    ("f", "cyrillic"): ("Анна", "Вера", "Галина", "Дарья", "Елена", "Жанна", "Зоя", "Ирина"),
    ("n", "cyrillic"): ("Саша", "Женя", "Валя", "Шура", "Слава", "Паша", "Тоня", "Лёля"),
}
# A character is replaced by one of its own group.
GROUPS = (
    "0123456789",
    "aeiou",
    "bcdfghjklmnpqrstvwxyz",
    "AEIOU",
    "BCDFGHJKLMNPQRSTVWXYZ",
    "àáâãäåèéêëìíîïòóôõöùúûüý",
    "çñßłśźżčšž",
    "ÀÁÂÄÅÈÉÊËÌÍÎÏÒÓÔÖÙÚÛÜ",
    "ÇÑŁŚŹŻČŠŽ",
    "аеиоуыэюя",
    "бвгджзйклмнпрстфхцчшщ",
    "АЕИОУЭЮЯ",
    "БВГДЖЗЙКЛМНПРСТФХЦЧШЩ",
    "αεηιουω",
    "βγδζθκλμνξπρστφχψ",
)
# Other letters, digits and marks are replaced by one of their kind; what is of no script listed here, by a Latin letter.
SCRIPTS = (
    (r"\p{IsHan}", "安北成大東方高光國海和華江金京林明南山新"),
    (r"\p{IsHiragana}", "あいうえおかきくけこさしすせそたちつてと"),
    (r"\p{IsKatakana}", "アイウエオカキクケコサシスセソタチツテト"),
    (r"\p{IsHangul}", "가나다라마바사아자차카타파하고노도로모보"),
    (r"\p{IsArabic}", "بتثجحخدرزسشصطعفقكلمنه"),
    (r"\p{IsHebrew}", "אבגדהוזחטיכלמנסעפצקר"),
    (r"\p{IsDevanagari}", "कखगघचछजझटठडढतथदधनपफब"),
    (r"\p{IsThai}", "กขคงจฉชซญดตถทธนบปผพม"),
    (r"\p{N}", "0123456789"),
    (r"\p{Lu}", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    (r"[\p{L}\p{M}]", "abcdefghijklmnopqrstuvwxyz"),
)
# After this many tries in its own form, an entity gets a longer or freer one with every further try.
SAME_FORM = 3
# Registrations under these names belong to nobody.
RESERVED = r"example\.(?:com|org|net)$"


def _keyed(key: str, *parts: Column) -> Column:
    """Hex digest of the parts under the key; nobody without the key can repeat it."""
    message = F.concat_ws("\u001f", *parts)
    inner = F.sha2(F.concat(F.lit(f"{key}\u001f1\u001f"), message), 256)
    return F.sha2(F.concat(F.lit(f"{key}\u001f2\u001f"), inner), 256)


def _stream(digest: Column, size: Column) -> Column:
    """Two hex digits for each of `size` characters."""
    blocks = F.sequence(F.lit(0), F.floor((F.greatest(size, F.lit(1)) - 1) / 32).cast("int"))
    return F.array_join(F.transform(blocks, lambda b: F.sha2(F.concat(digest, F.lit("/"), b.cast("string")), 256)), "")


def _pick(stream: Column, at: Column) -> Column:
    """The number, 0 to 255, at a place of the stream."""
    return F.conv(F.substring(stream, 2 * at + 1, F.lit(2)), 16, 10).cast("int")


def _letter(group: str, number: Column) -> Column:
    return F.substring(F.lit(group), F.pmod(number, F.lit(len(group))) + 1, F.lit(1))


def _given(value: Column, body) -> Column:
    """`body` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _respelled(value: Column, digest: Column) -> Column:
    """Every letter and digit replaced by one of its group or script; other characters stay."""

    def spell(stream):
        def one(letter, at):
            out = F.when(F.lit(False), letter)
            for group in GROUPS:
                out = out.when(F.instr(F.lit(group), letter) > 0, _letter(group, _pick(stream, at)))
            out = out.when(~letter.rlike(r"[\p{L}\p{N}\p{M}]"), letter)
            for script, letters in SCRIPTS:
                out = out.when(letter.rlike(script), _letter(letters, _pick(stream, at)))
            return out.otherwise(letter)

        return F.array_join(F.transform(F.split(value, ""), one), "")

    return F.when(value == "", value).otherwise(_given(_stream(digest, F.length(value)), spell))


def _longer(new: Column, attempt: Column, digest: Column, letters: str) -> Column:
    """One more keyed letter behind `new` for every try after those in the same form."""
    more = F.greatest(attempt.cast("int") - (SAME_FORM - 1), F.lit(0))

    def grow(stream):
        tail = F.transform(F.sequence(F.lit(1), more), lambda i: _letter(letters, _pick(stream, i - 1)))
        return F.concat(new, F.array_join(tail, ""))

    widened = _given(_stream(F.sha2(F.concat(digest, F.lit("+")), 256), more), grow)
    return F.when(more > 0, widened).otherwise(new)


def canonical(kind: Column, match: Column, gender: Column) -> Column:
    """What counts as the same entity: case and, in numbers, everything but digits left out."""
    return (
        F.when(kind.isin("phone", "card", "ssn"), F.regexp_replace(match, "[^0-9]", ""))
        .when(kind == "name", F.concat(gender, F.lit("|"), F.lower(match)))
        .otherwise(F.lower(match))
    )


def kind_of(match: Column) -> Column:
    whole = [(kind, f"^(?:{pattern})$") for kind, pattern in zip(TYPES, (EMAIL, IP, PHONE, CARD, SSN))]
    out = F.when(F.lit(False), F.lit(""))
    for kind, pattern in whole:
        out = out.when(match.rlike(pattern), F.lit(kind))
    return out.otherwise(F.lit("name"))


def _email(value: Column, attempt: Column, key: str) -> Column:
    local, domain = F.split(value, "@")[0], F.split(value, "@")[1]
    kept = F.when(domain.rlike(RESERVED), F.regexp_extract(domain, rf"({RESERVED})", 1)).otherwise(
        F.regexp_extract(domain, r"([^.]+)$", 1)
    )
    rest = F.substring(domain, F.lit(1), F.length(domain) - F.length(kept))
    digest = _keyed(key, F.lit("email"), value, attempt)
    return F.concat(
        _longer(_respelled(local, digest), attempt, digest, "abcdefghijkmnpqrstuvwxyz23456789"),
        F.lit("@"),
        _respelled(rest, _keyed(key, F.lit("domain"), domain, F.lit("0"))),
        kept,
    )


def _ip(value: Column, attempt: Column, key: str) -> Column:
    """Same number of digits in each part; private and loopback networks stay what they are.

    Further tries take any number in a part, then any address of 10.0.0.0/8 for a private one and any other
    for the rest, then the reserved 240.0.0.0/4, and at last a local IPv6 address.
    """
    kept = (
        F.when(value.rlike(r"^(?:10|127)\."), F.lit(1))
        .when(value.rlike(r"^(?:192\.168|172\.(?:1[6-9]|2[0-9]|3[01]))\."), F.lit(2))
        .otherwise(F.lit(0))
    )

    def build(digest):
        def part(old, at):
            n, first = _pick(digest, at), at == 0
            new = (
                F.when(F.length(old) == 1, 1 + F.pmod(n, F.lit(9)))
                .when(F.length(old) == 2, 11 + F.pmod(n, F.lit(89)))
                .when(first, 128 + F.pmod(n, F.lit(44)))
                .otherwise(100 + F.pmod(n, F.lit(155)))
            )
            return F.when(at < kept, old).otherwise(new.cast("string"))

        def any_number(old, at):
            return F.when(at < kept, old).otherwise(_pick(digest, at).cast("string"))

        def local(groups):
            return F.transform(groups, lambda i: F.substring(digest, 4 * i + 1, F.lit(4)))

        parts, tried = F.split(value, r"\."), attempt.cast("int")
        numbers = [_pick(digest, F.lit(at)) for at in range(4)]
        private = F.concat_ws(".", F.lit("10"), *numbers[1:])
        public = F.concat_ws(".", 11 + F.pmod(numbers[0], F.lit(89)), *numbers[1:])
        return (
            F.when(tried < SAME_FORM, F.array_join(F.transform(parts, part), "."))
            .when((tried < 2 * SAME_FORM) & (kept > 0), F.array_join(F.transform(parts, any_number), "."))
            .when(tried < 4 * SAME_FORM, F.when(kept > 0, private).otherwise(public))
            .when(tried < 6 * SAME_FORM, F.concat_ws(".", 240 + F.pmod(numbers[0], F.lit(15)), *numbers[1:]))
            .otherwise(F.concat(F.lit("fd00:"), F.array_join(local(F.sequence(F.lit(0), F.lit(6))), ":")))
        )

    return _given(_keyed(key, F.lit("ip"), value, attempt), build)


def _digits(value: Column, digest: Column, kept: Column, fixed: Column) -> Column:
    """New digits behind the first `kept`; `fixed` names places that stay (an array)."""

    def build(stream):
        def one(old, at):
            new = F.pmod(_pick(stream, at), F.lit(10))
            # What follows the kept digits starts an area or a number: not 0 or 1.
            new = F.when(at == kept, 2 + F.pmod(_pick(stream, at), F.lit(8))).otherwise(new)
            return F.when((at < kept) | F.array_contains(fixed, at), old).otherwise(new.cast("string"))

        return F.array_join(F.transform(F.split(value, ""), one), "")

    return _given(_stream(digest, F.length(value)), build)


def _phone(value: Column, attempt: Column, key: str) -> Column:
    """Country code, trunk zero and the fictitious exchange 555 stay."""
    us = value.rlike("^[17]") & (F.length(value) == 11)
    kept = (
        F.when(value.rlike("^00"), F.lit(4))
        .when(us | value.rlike("^0"), F.lit(1))
        .when(F.length(value) > 10, F.lit(2))
        .otherwise(F.lit(0))
    )
    exchange = F.when(us, F.lit(5)).otherwise(F.lit(4))
    fictitious = F.substring(value, exchange, F.lit(3)) == "555"
    fixed = F.when(fictitious, F.transform(F.array(*map(F.lit, range(3))), lambda i: exchange - 1 + i)).otherwise(
        F.array().cast("array<int>")
    )
    digest = _keyed(key, F.lit("phone"), value, attempt)
    return _longer(_digits(value, digest, kept, fixed), attempt, digest, GROUPS[0])


def _luhn_rest(digits: Column) -> Column:
    """The last digit that completes `digits` to a number with a valid check digit."""
    total = F.aggregate(
        F.transform(
            F.split(F.reverse(digits), ""),
            lambda d, i: F.when(
                i % 2 == 0, F.get(F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))), d.cast("int"))
            ).otherwise(d.cast("int")),
        ),
        F.lit(0),
        lambda total, d: total + d,
    )
    return F.pmod(-total, F.lit(10))


def _card(value: Column, attempt: Column, key: str) -> Column:
    """The first digit stays, and the check digit is right if and only if it was."""
    size = F.length(value)
    head = F.substring(value, F.lit(1), size - 1)
    valid = _luhn_rest(head).cast("string") == F.substring(value, size, F.lit(1))
    digest = _keyed(key, F.lit("card"), value, attempt)
    return _given(
        _digits(head, digest, F.lit(1), F.array().cast("array<int>")),
        lambda new: F.concat(
            new,
            F.pmod(
                _luhn_rest(new) + F.when(valid, F.lit(0)).otherwise(1 + F.pmod(_pick(digest, F.lit(31)), F.lit(9))),
                F.lit(10),
            ).cast("string"),
        ),
    )


def _ssn(value: Column, attempt: Column, key: str) -> Column:
    """Numbers from 900 on are never given out."""
    digest = _keyed(key, F.lit("ssn"), value, attempt)
    tail = _digits(F.substring(value, F.lit(2), F.lit(8)), digest, F.lit(0), F.array().cast("array<int>"))
    return _longer(F.concat(F.lit("9"), tail), attempt, digest, GROUPS[0])


def _name(value: Column, attempt: Column, key: str) -> Column:
    """A given name of the same gender and script, and a respelled family name."""
    gender, written = F.split(value, r"\|")[0], F.split(value, r"\|")[1]
    parts = F.split(written, " ")
    family = F.element_at(parts, -1)
    number = _pick(_keyed(key, F.lit("given"), gender, parts[0], attempt), F.lit(0))
    script = F.when(written.rlike(r"\p{IsCyrillic}"), F.lit("cyrillic")).otherwise(F.lit("latin"))
    given = F.when(F.lit(False), F.lit(""))
    for (of, letters), names in GIVEN.items():
        chosen = F.get(F.array(*map(F.lit, names)), F.pmod(number, F.lit(len(names))))
        given = given.when((gender == of) & (script == letters), chosen)
    digest = _keyed(key, F.lit("family"), family, attempt)
    new = _longer(_respelled(family, digest), attempt, digest, "aeiounrslt")
    return F.concat(gender, F.lit("|"), F.when(F.size(parts) > 1, F.concat(F.lower(given), F.lit(" "), new)).otherwise(new))


def surrogate(kind: Column, value: Column, attempt: Column, key: str) -> Column:
    """Replacement of a canonical value, canonical as well.

    The first tries keep the form of the value; each later one has more to choose from than the one before.
    """
    tried = attempt.cast("string")
    return (
        F.when(kind == "email", _email(value, tried, key))
        .when(kind == "ip", _ip(value, tried, key))
        .when(kind == "phone", _phone(value, tried, key))
        .when(kind == "card", _card(value, tried, key))
        .when(kind == "ssn", _ssn(value, tried, key))
        .otherwise(_name(value, tried, key))
    )


def poured(kind: Column, match: Column, new: Column) -> Column:
    """A replacement in the written form of the match: its separators, its capitals."""
    places = F.transform(F.split(match, ""), lambda c: c.rlike("[0-9]").cast("int"))
    digits = F.aggregate(places, F.lit(0), lambda a, b: a + b)
    number = F.array_join(
        F.transform(
            F.split(match, ""),
            lambda c, i: F.when(
                c.rlike("[0-9]"),
                F.substring(
                    new, F.aggregate(F.slice(places, F.lit(1), i + 1), F.lit(0), lambda a, b: a + b), F.lit(1)
                ),
            ).otherwise(c),
        ),
        "",
    )
    # A longer replacement has its further digits at the end.
    number = F.concat(number, F.substring(new, digits + 1, F.greatest(F.length(new) - digits, F.lit(0))))
    name = F.split(new, r"\|")[1]
    # Capitals at the beginning of words and behind hyphens and apostrophes.
    name = F.array_join(
        F.transform(
            F.split(name, ""),
            lambda c, i: F.when((i == 0) | F.substring(name, i, F.lit(1)).isin(" ", "-", "'", "’"), F.upper(c)).otherwise(c),
        ),
        "",
    )
    cased = F.array_join(
        F.transform(
            F.split(new, ""),
            lambda c, i: F.when(F.substring(match, i + 1, F.lit(1)).rlike(r"\p{Lu}"), F.upper(c)).otherwise(c),
        ),
        "",
    )
    return (
        F.when(kind.isin("phone", "card", "ssn"), number)
        .when(kind == "name", name)
        .when(kind == "email", cased)
        .otherwise(new)
    )


def _gender(before: Column) -> Column:
    """What the forms of address just before a name say; null where there is none."""
    neutral = rf"(?:(?:{'|'.join(TITLES['n'])})\.? )"
    out = F.when(F.lit(False), F.lit(""))
    for gender in ("m", "f"):
        out = out.when(before.rlike(rf"(?<!\p{{L}})(?:{'|'.join(TITLES[gender])})\.? {neutral}{{0,3}}$"), F.lit(gender))
    return out.when(before.rlike(rf"(?<!\p{{L}}){neutral}$"), F.lit("n"))


def _is_name(match: Column) -> Column:
    return ~match.rlike("[0-9@]")


def _family(name: Column) -> Column:
    return F.element_at(F.split(name, " "), -1)


def entity_pieces(text: Column) -> Column:
    """The text cut at its entities: what is before the first, the first, what is between, the second, and so on."""
    apart = F.split(F.regexp_replace(text, F.lit(ENTITY), F.lit(f"{_MARK}$0{_MARK}")), _MARK, -1)
    twice = F.zip_with(
        F.split(text, ENTITY, -1),
        F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0)),
        lambda gap, match: F.when(match.isNull(), F.array(gap)).otherwise(F.array(gap, match)),
    )
    return F.when(F.instr(text, _MARK) == 0, apart).otherwise(F.flatten(twice))


def name_pieces(pieces: Column) -> Column:
    """The same pieces, cut further where a person named in them is named again, whole or by the last name, without a title."""
    names = F.filter(pieces, lambda piece, i: (i % 2 == 1) & _is_name(piece))
    forms = F.array_distinct(F.concat(names, F.transform(names, _family)))
    # The longest form that fits is taken.
    longest = F.transform(
        F.sort_array(F.transform(forms, lambda form: F.struct(-F.length(form), form.alias("form")))),
        lambda one: F.concat(F.lit(r"\Q"), one["form"], F.lit(r"\E")),
    )
    pattern = F.concat(
        F.lit(r"(?<![\p{L}\p{M}\p{N}])(?=\p{Lu})(?:"),
        F.array_join(longest, "|"),
        F.lit(r")(?![\p{L}\p{M}\p{N}]|['’-]\p{Lu})"),
    )

    def cut(pattern):
        return F.flatten(
            F.transform(
                pieces,
                lambda piece, i: F.when(
                    (i % 2 == 1) | (F.instr(piece, _MARK) > 0), F.array(piece)
                ).otherwise(F.split(F.regexp_replace(piece, pattern, F.lit(f"{_MARK}$0{_MARK}")), _MARK, -1)),
            )
        )

    return F.when(F.size(names) > 0, _given(pattern, cut)).otherwise(pieces)


def assign_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """`kind`, `value`, `surrogate` for all distinct entities, without two entities sharing a surrogate.

    Everybody starts with its keyed replacement. Where two meet, or one is an entity of the corpus
    itself, all but the first in keyed order try again, until nobody meets anybody. Where the form of an
    entity has no free replacement, later tries leave it, so everybody settles (a card keeps its form; there are 10 ** 11
    of the shortest). The tables hold distinct entities only, never their mentions.
    """
    named = landed(
        entities.select("kind", "value").distinct().withColumn("attempt", F.lit(0)), "surrogates-tried"
    )
    same = Window.partitionBy("kind", "surrogate").orderBy("settled", "order")
    pending, settled = named, None
    while True:
        tried = pending.withColumn("surrogate", surrogate(F.col("kind"), F.col("value"), F.col("attempt"), key))
        tried = tried.withColumns(
            {"order": _keyed(key, F.lit("order"), F.col("kind"), F.col("value")), "settled": F.lit(1)}
        ).select("kind", "value", "attempt", "surrogate", "order", "settled")
        if settled is not None:
            tried = tried.union(settled.withColumn("settled", F.lit(0)))
        ranked = tried.withColumn("place", F.row_number().over(same))
        real = named.select("kind", F.col("value").alias("surrogate"), F.lit(True).alias("is_real"))
        judged = landed(ranked.join(real, ["kind", "surrogate"], "left"), "surrogates-judged")
        good = (F.col("settled") == 0) | ((F.col("place") == 1) & F.col("is_real").isNull())
        settled = judged.where(good).select("kind", "value", "attempt", "surrogate", "order")
        pending = judged.where(~good).select("kind", "value", (F.col("attempt") + 1).alias("attempt"))
        if pending.isEmpty():
            return settled.select("kind", "value", "surrogate")


def replace_personal_data(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """One row per row of `docs`: `row`, a struct of all its columns with the new text, and `mentions`.

    Mentions are an array of (at, kind, match, replacement) in the order of the text. The same entity
    gets the same replacement everywhere, different entities get different ones.

    A person found behind a form of address is replaced later in the same text as well, by full or last name; a first name
    alone is not. A null text stays null, an empty one empty; rows without an entity pass unchanged; repeated rows get
    the same replacements; no rows give none. Columns may have any names. Entities are joined to their
    replacements by value, so one that a third of all documents mention is split by the join; a text's
    own mentions are gathered again, one list per document. Texts of any length are scanned whole and once for entities;
    the further look for persons takes time by the capitals in the text times the persons it names.
    """
    col = F.col("row").getField(text)
    rows = docs.select(F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row"))
    found = rows.withColumn("pieces", entity_pieces(col)).select(
        F.when(F.size("pieces") > 1, F.col("row").withField(f"`{text}`", F.lit(None).cast("string")))
        .otherwise(F.col("row"))
        .alias("row"),
        F.when(F.size("pieces") > 1, name_pieces(F.col("pieces"))).alias("pieces"),
        F.monotonically_increasing_id().alias("row_key"),
    )
    # One table of all rows: the texts are read and scanned once.
    scanned = landed(found, "surrogates-rows")
    marked = scanned.where("pieces IS NOT NULL")
    mentions = marked.select("row_key", F.posexplode(_pairs(F.col("pieces"))).alias("at", "pair")).select(
        "row_key", "at", F.col("pair.match").alias("match"), F.col("pair.before").alias("before")
    )
    mentions = mentions.withColumn("kind", kind_of(F.col("match"))).select(
        "row_key",
        "at",
        "match",
        "kind",
        F.when(F.col("kind") == "name", _gender(F.col("before"))).alias("gender"),
    )
    # A mention without a title has the gender of the first one with it, of the same full name if there is one.
    named = mentions.where("kind = 'name'")
    for whose, form in (("same", F.lower("match")), ("family", F.lower(_family(F.col("match"))))):
        first = Window.partitionBy("row_key", form).orderBy(F.col("gender").isNull(), "at")
        named = named.withColumn(whose, F.first("gender").over(first))
    named = named.withColumn("gender", F.coalesce("gender", "same", "family", F.lit("n"))).drop("same", "family")
    mentions = named.union(mentions.where("kind <> 'name'"))
    mentions = landed(
        mentions.withColumn("value", canonical(F.col("kind"), F.col("match"), F.col("gender"))), "surrogates-mentions"
    )
    assigned = landed(assign_surrogates(mentions, key), "surrogates-assigned")
    replaced = mentions.join(assigned, ["kind", "value"]).select(
        "row_key",
        "at",
        "kind",
        "match",
        poured(F.col("kind"), F.col("match"), F.col("surrogate")).alias("replacement"),
    )
    lists = replaced.groupBy("row_key").agg(
        F.array_sort(F.collect_list(F.struct("at", "kind", "match", "replacement"))).alias("mentions")
    )
    full = marked.join(lists, "row_key")
    gaps = F.filter("pieces", lambda piece, i: i % 2 == 0)
    rebuilt = F.array_join(
        F.zip_with(gaps, "mentions", lambda gap, m: F.concat(gap, F.coalesce(m["replacement"], F.lit("")))), ""
    )
    changed = full.select(F.col("row").withField(f"`{text}`", rebuilt).alias("row"), "mentions")
    none = F.array().cast(changed.schema["mentions"].dataType)
    return changed.union(scanned.where("pieces IS NULL").select("row", none.alias("mentions")))


def _pairs(pieces: Column) -> Column:
    """(end of the text before it, match) of every entity."""
    # Forms of address are short; what is before them does not matter.
    return F.filter(
        F.transform(
            pieces,
            lambda piece, i: F.struct(
                F.when(i % 2 == 1, piece).alias("match"), F.right(F.get(pieces, i - 1), F.lit(80)).alias("before")
            ),
        ),
        lambda pair: pair["match"].isNotNull(),
    )
