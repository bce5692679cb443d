"""Surrogates for personal data and secrets.

Entities are found by one pattern. Each is taken apart into units (an e-mail address into mailbox and
domain, a titled name into its names; the document's other mentions of those names count, too), and a unit's plain form (its letters and digits, lower-cased)
is what two mentions have in common, however they are written. A keyed digest of kind and plain form
gives the surrogate: letters become letters of the same script, digits digits, card numbers keep a
valid check digit, octets stay octets, and names come from lists by gender and script. So a mention
gets the same surrogate in every document, and nobody without the key can undo it.

Surrogates are checked before they are used: if two units of a kind would get the same one, or one
would get what is another's real value, all but one try again with the next digest, until all
differ. Then the surrogates are written in the form of each mention: its case, separators, length.

Only DataFrame functions are used. Mentions are joined with units and collected per document; texts
are shuffled only if the replacements are not measured to be small.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textsignal.llm.common import measured_broadcast
from textsignal.llm.store import stored

KEY = "surrogates-1"

# The forms of entities. All are looked for at once, the first that fits counts.
TITLES = {
    "m": ["Mr", "Mister", "Herr", "Monsieur", "Señor", "Sr", "Signor", "г-н"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Signora", "г-жа"],
    "n": ["Dr", "Prof"],
}
TITLE = "(?:" + "|".join(dict.fromkeys(w for ts in TITLES.values() for t in ts for w in (t, t.upper()))) + ")"
#: In texts in capitals throughout, words that end a name.
STOPS = (
    "I A AN AND ARE AS AT BE BUT BY FOR FROM HAD HAS HAVE HE HER HIS IF IN IS IT NOT OF ON OR SAID SAYS SHE THAT "
    "THE THEN THIS TO WAS WERE WHEN WHO WILL WITH WOULD DER DIE DAS UND IST WAR HAT IM MIT ET EST LE LA LES "
    "DANS POUR EL LOS LAS ES EN CON"
).replace(" ", "|")
PARTICLE = "(?:de|da|do|dos|das|del|della|di|du|la|le|van|von|vom|zu|zum|zur|den|der|ten|ter|af|av|bin|ibn|el|al|y)"
INITIAL = r"\p{Lu}\p{M}*+\."
#: A capitalised word, with its parts after apostrophes and hyphens; one of a script without case.
WORD = (
    rf"(?!(?:{STOPS}|{TITLE})(?![\p{{L}}\p{{M}}]))\p{{Lu}}[\p{{L}}\p{{M}}]*+"
    r"(?:['’]\p{Lu}[\p{L}\p{M}]++|-\p{Lu}[\p{L}\p{M}]*+)*+"
)
CASELESS = r"\p{Lo}[\p{Lo}\p{Lm}\p{M}‌‍]*+"
ELEMENT = f"(?:{INITIAL}|{WORD}|{CASELESS})"
#: All the words of a name.
RUN = rf"(?:{PARTICLE}[  ])*+{ELEMENT}(?:(?:[  ]|(?<=\p{{Lu}}\.)-?)(?:{PARTICLE}[  ])*+{ELEMENT})*+"
#: What an assigned secret follows, up to its opening quote; it may stand at the end of a longer name.
ASSIGNED = r"(?i:password|passwd|pwd|secret|token|api[_\-]?key|access[_\-]?key)\\?[\"']?\s{0,3}[=:]\s{0,3}"
FORMS = {
    "block": r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----[\s\S]+?-----END [A-Z ]{0,20}PRIVATE KEY-----",
    "email": r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}._%+\-]++@[\p{L}\p{N}\-]++(?:\.[\p{L}\p{N}\-]++)++",
    # Up to the closing quote on the line, or to white space or a quote, without the stops that end a sentence.
    "assigned": ASSIGNED + r"(?:\"(?:[^\"\\\r\n]|\\[^\r\n]){8,}+\"|'(?:[^'\\\r\n]|\\[^\r\n]){8,}+'"
    r"|\\?[\"']?[^\s\"']{7,}[^\s\"'.,;:!?)\]}>\\])",
    "key": r"(?<!\w)(?:(?:AKIA|ASIA)[0-9A-Z]{16}(?!\w)|gh[pousr]_[A-Za-z0-9]{36,}|sk-[A-Za-z0-9]{20,}|xox[abprs]-[A-Za-z0-9\-]{10,})",
    "iban": r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    "ip": r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\w|\.\d)",
    "card": r"(?<![\w.+\-])(?:\d[ \-]?){12,18}\d(?![\w\-])",
    "phone": r"(?<![\w.])\+\d{1,3}[ .\-]?\(?\d{1,4}\)?(?:[ .\-]?\d{2,4}){2,4}(?!\w)"
    r"|(?<![\w.])\(\d{3}\) ?\d{3}[ .\-]\d{4}(?!\w)|(?<![\w.\-])\d{3}[.\-]\d{3}[.\-]\d{4}(?![\w\-])",
    "ssn": r"(?<![\w\-])\d{3}-\d{2}-\d{4}(?![\w\-])",
    "person": rf"(?<![\p{{L}}\p{{N}}]){TITLE}\.?[ \u00a0]{RUN}",
}
#: What an entity of a form can begin with, so that most forms are tried in few places only.
STARTS = {
    "block": "-",
    "assigned": "[AaPpSsTt]",
    "key": "[Agsx]",
    "iban": "[A-Z]",
    "ip": r"\d",
    "card": r"\d",
    "phone": r"[\d+(]",
    "ssn": r"\d",
    "person": r"[\p{Lu}г]",
}
#: All forms; each has its own bounds on the left.
PATTERN = "|".join(
    (f"(?={STARTS[name]})" if name in STARTS else "") + f"(?:{form})" for name, form in FORMS.items()
)

#: Names by gender for Latin and Cyrillic script, and syllables that make family names.
FIRST = {
    "m": ["Adam", "Boris", "Carl", "David", "Erik", "Felix", "Georg", "Hugo", "Ivan", "Jonas", "Karl", "Leon", "Max", "Nils", "Oskar", "Paul"],
    "f": ["Anna", "Berta", "Clara", "Diana", "Emma", "Flora", "Greta", "Helena", "Irma", "Julia", "Karla", "Laura", "Maria", "Nora", "Olga", "Paula"],
    "n": ["Alex", "Andy", "Charlie", "Chris", "Dana", "Jamie", "Jordan", "Kim", "Lee", "Lou", "Max", "Nicky", "Robin", "Sam", "Sasha", "Toni"],
}
FIRST_CYRILLIC = {
    "m": ["Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Кирилл", "Лев", "Максим", "Никита", "Олег", "Павел", "Роман", "Сергей", "Тимур"],
    "f": ["Алина", "Вера", "Галина", "Дарья", "Елена", "Жанна", "Ирина", "Клара", "Лидия", "Мария", "Нина", "Ольга", "Полина", "Раиса", "Софья", "Тамара"],
    "n": ["Саша", "Женя", "Валя", "Паша", "Слава", "Шура", "Тоня", "Рома", "Лёва", "Мила", "Ника", "Юля", "Яна", "Зоя", "Ася", "Ия"],
}
LAST = ["bar", "ber", "dal", "den", "fel", "gar", "hol", "kin", "lan", "mar", "nor", "per", "ros", "sel", "tor", "ver"]
LAST_CYRILLIC = ["бар", "вер", "гор", "дал", "зим", "кон", "лев", "мар", "нов", "пол", "рос", "сел", "тар", "фед", "чер", "яков"]

#: Letters by script: a letter is replaced by one of its own row.
ROWS = [
    "0123456789",
    "abcdefghijklmnopqrstuvwxyz",
    "àáâãäåæçèéêëìíîïñòóôõöøùúûüýÿœß",
    "абвгдежзийклмнопрстуфхцчшщъыьэюяё",
    "αβγδεζηθικλμνξοπρστυφχψω",
    "一二三上下大小中人天日月水火山石田土木本",
]
CYRILLIC = r"\p{IsCyrillic}"


def _literal(text: str) -> Column:
    return F.lit(text)


def _part(kind: Column | str, value: Column) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return F.struct(kind.alias("kind"), value.alias("value"))


def _shown(value: Column) -> Column:
    """A part that is written as it is."""
    return _part(F.lit(None).cast("string"), value)


def form_of(entity: Column) -> Column:
    """The form that an entity has: the first one that fits it whole."""
    found = F.lit("person")
    for name, form in reversed(FORMS.items()):
        found = F.when(entity.rlike(rf"^(?:{form})$"), F.lit(name)).otherwise(found)
    return found


def parts_of(entity: Column, form: Column) -> Column:
    """An entity as parts (kind, value); parts without a kind are written as they are."""
    titles = {g: rf"^(?:{'|'.join([*ts, *(t.upper() for t in ts)])})\.?[  ]" for g, ts in TITLES.items()}
    gender = F.when(entity.rlike(titles["m"]), "m").when(entity.rlike(titles["f"]), "f").otherwise("n")
    title = F.regexp_extract(entity, rf"^({TITLE}\.?[  ])", 1)
    # Names, and what stands between them: particles, spaces, hyphens.
    tokens = F.regexp_extract_all(
        F.substring(entity, F.length(title) + 1, F.length(entity)), F.lit(rf"{ELEMENT}|\p{{Ll}}++|[\s\S]"), F.lit(0)
    )
    is_initial = rf"^{INITIAL}$"
    ordered = F.transform(
        tokens,
        lambda t, i: F.struct(
            t.alias("t"), (t.rlike(r"^[\p{Lu}\p{Lo}]") & ~t.rlike(is_initial)).alias("named"), i.alias("i")
        ),
    )
    last = F.array_max(F.transform(F.filter(ordered, lambda x: x["named"]), lambda x: x["i"]))
    said = F.aggregate(
        ordered,
        F.array().cast("array<struct<kind:string,value:string>>"),
        lambda made, x: F.concat(
            made,
            F.array(
                _part(
                    F.when(x["named"] & (x["i"] == last), "last")
                    .when(x["named"], F.concat(F.lit("first_"), gender))
                    .when(x["t"].rlike(is_initial), "initial"),
                    x["t"],
                )
            ),
        ),
    )
    person = F.concat(F.array(_shown(title)), said)
    assigned = rf"^({ASSIGNED}\\?[\"']?)([\s\S]+?)([\"']?)$"
    prefix = r"^(AKIA|ASIA|gh[pousr]_|sk-|xox[abprs]-)(.*)$"
    framed = r"^(-----BEGIN [A-Z ]*-----)([\s\S]*)(-----END [A-Z ]*-----)$"
    return (
        F.when(
            form == "email",
            F.array(
                _part("mailbox", F.substring_index(entity, "@", 1)),
                _shown(F.lit("@")),
                _part("domain", F.substring_index(entity, "@", -1)),
            ),
        )
        .when(
            form == "assigned",
            F.array(
                _shown(F.regexp_extract(entity, assigned, 1)),
                _part("secret", F.regexp_extract(entity, assigned, 2)),
                _shown(F.regexp_extract(entity, assigned, 3)),
            ),
        )
        .when(
            form == "key",
            F.array(
                _shown(F.regexp_extract(entity, prefix, 1)),
                _part("secret", F.regexp_extract(entity, prefix, 2)),
            ),
        )
        .when(
            form == "block",
            F.array(
                _shown(F.regexp_extract(entity, framed, 1)),
                _part("secret", F.regexp_extract(entity, framed, 2)),
                _shown(F.regexp_extract(entity, framed, 3)),
            ),
        )
        .when(form == "person", person)
        .otherwise(F.array(_part(form, entity)))
    )


def plain_of(kind: Column, value: Column) -> Column:
    """What the mentions of a unit have in common."""
    bare = F.lower(F.regexp_replace(value, r"[^\p{L}\p{N}]", ""))
    # Secrets differ by case; addresses of hosts need their dots.
    return (
        F.when(kind == "secret", value)
        .when(kind.isin("ip", "domain", "mailbox"), F.lower(value))
        .otherwise(bare)
    )


def _stream(kind: Column, plain: Column, attempt: Column, key: str, size: Column) -> Column:
    """Hex digits of a keyed digest, two for each letter of a plain form."""
    blocks = F.sequence(F.lit(0), F.floor(size / 32).cast("int"))
    inner = F.concat_ws("\x1f", kind, attempt.cast("string"), plain)
    return F.array_join(
        F.transform(
            blocks,
            lambda b: F.sha2(
                F.concat(
                    F.lit(f"{key}\x1f"),
                    F.sha2(F.concat(F.lit(f"{key}\x1f"), b.cast("string"), F.lit("\x1f"), inner), 256),
                ),
                256,
            ),
        ),
        "",
    )


def _byte(stream: Column, i: Column) -> Column:
    return F.conv(F.substring(stream, i * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _pick(row: str, number: Column) -> Column:
    return F.substring(F.lit(row), number % len(row) + 1, F.lit(1))


def _with_bytes(plain: Column, stream: Column, one: Callable[[Column, Column], Column]) -> Column:
    """`one` of each letter and its byte; both are cut once, so that long secrets take linear time."""
    letters = F.split(plain, "")
    pairs = F.regexp_extract_all(stream, F.lit(".."), F.lit(0))
    return F.zip_with(letters, F.slice(pairs, 1, F.size(letters)), one)


def _scrambled(plain: Column, stream: Column) -> Column:
    """Every letter or digit replaced by one of its row, other signs as they are."""

    def one(letter: Column, byte: Column) -> Column:
        number = F.conv(byte, 16, 10).cast("int")
        lowered = F.lower(letter)
        found = letter
        for row in reversed(ROWS):
            inside = F.position(lowered, F.lit(row)) > 0
            new = _pick(row, number)
            found = F.when(inside, F.when(letter == lowered, new).otherwise(F.upper(new))).otherwise(found)
        return found

    return F.array_join(_with_bytes(plain, stream, one), "")


def _luhn(digits: Column) -> Column:
    """The sum of the check of card numbers; valid if it ends in 0."""
    size = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, i + 1, F.lit(1)).cast("int")
        double = (size - i) % 2 == 0
        return total + F.when(double, digit * 2 - F.when(digit > 4, 9).otherwise(0)).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(0), size - 1), F.lit(0), add)


def _remainder(iban: Column) -> Column:
    """An IBAN, letters as numbers from 10, moved by four, modulo 97."""
    moved = F.concat(F.substring(iban, F.lit(5), F.length(iban)), F.substring(iban, F.lit(1), F.lit(4)))

    def add(total: Column, i: Column) -> Column:
        letter = F.substring(moved, i + 1, F.lit(1))
        number = F.when(letter.rlike("[0-9]"), letter.cast("int")).otherwise(F.ascii(letter) - 87)
        return (total * F.when(number > 9, 100).otherwise(10) + number) % 97

    return F.aggregate(F.sequence(F.lit(0), F.length(moved) - 1), F.lit(0), add)


def _from(rows: list[str], number: Column) -> Column:
    return F.get(F.array(*map(_literal, rows)), number % len(rows))


def surrogate_of(kind: Column, plain: Column, attempt: Column, key: str) -> Column:
    """The plain form of a unit's surrogate, for the kinds of `parts_of`.

    After some attempts there may be more letters, longer octets or longer names, so that a small
    number of possible values is no end.
    """
    size = F.length(plain) + 40
    stream = _stream(kind, plain, attempt, key, size)
    more = F.floor(attempt / 4).cast("int")
    longer = F.concat(plain, F.repeat(F.lit("a"), more))
    scrambled = _scrambled(longer, stream)
    digits = _scrambled(plain, stream)

    def octet(i: Column) -> Column:
        own = F.length(F.get(F.split(plain, r"\."), i))
        number = _byte(stream, i) * 256 + _byte(stream, i + 4)
        return (
            F.when(attempt >= 4, number % 254 + 1)
            .when(own == 1, number % 9 + 1)
            .when(own == 2, number % 90 + 10)
            .otherwise(number % 155 + 100)
            .cast("string")
        )

    address = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), octet), ".")
    # Cards keep their first digit, and a right check digit if they had one.
    n = F.length(plain)
    body = F.concat(F.substring(plain, F.lit(1), F.lit(1)), F.substring(digits, F.lit(2), n - 2))
    check = ((10 - _luhn(F.concat(body, F.lit("0"))) % 10) % 10).cast("string")
    card = F.concat(body, F.when(_luhn(plain) % 10 == 0, check).otherwise(F.substring(digits, n, F.lit(1))))
    account = F.substring(scrambled, F.lit(5), F.length(scrambled))
    country = F.substring(plain, F.lit(1), F.lit(2))
    right = F.lpad((98 - _remainder(F.concat(country, F.lit("00"), account))).cast("string"), 2, "0")
    iban = F.concat(country, F.when(_remainder(plain) == 1, right).otherwise(F.substring(digits, F.lit(3), F.lit(2))), account)
    # Hosts end in the top-level domain that is reserved for examples.
    host = F.concat(F.regexp_replace(scrambled, r"\.[^.]*$", ""), F.lit(".example"))
    phone = F.concat(F.substring(plain, F.lit(1), F.lit(1)), F.substring(digits, F.lit(2), n))
    hexadecimal = plain.rlike("^(?:[0-9a-f]{12,}|[0-9A-F]{12,})$")

    def nibble(letter: Column, byte: Column) -> Column:
        number = F.conv(byte, 16, 10).cast("int")
        new = F.when(letter.rlike("[0-9]"), _pick("0123456789", number)).otherwise(_pick("abcdef", number))
        return F.when(letter.rlike("[A-F]"), F.upper(new)).otherwise(new)

    hexed = F.array_join(_with_bytes(plain, stream, nibble), "")
    is_cyrillic = plain.rlike(CYRILLIC)

    def syllables(rows: list[str]) -> Column:
        count = F.lit(2) + more
        return F.array_join(
            F.transform(F.sequence(F.lit(0), count), lambda i: _from(rows, _byte(stream, i + 1))), ""
        )

    # Past the first attempts a first name is a double name.
    def first(gender: str) -> Column:
        def of(rows: list[str], family: list[str]) -> Column:
            own = F.lower(_from(rows, _byte(stream, F.lit(0))))
            return F.when(attempt < 4, own).otherwise(F.concat(own, syllables(family)))

        return F.when(is_cyrillic, of(FIRST_CYRILLIC[gender], LAST_CYRILLIC)).otherwise(of(FIRST[gender], LAST))

    family = F.when(is_cyrillic, syllables(LAST_CYRILLIC)).otherwise(syllables(LAST))
    return (
        F.when(kind == "ip", address)
        .when(kind == "card", card)
        .when(kind == "iban", iban)
        .when(kind == "domain", host)
        .when(kind == "phone", phone)
        .when((kind == "secret") & hexadecimal, hexed)
        .when(kind == "first_m", first("m"))
        .when(kind == "first_f", first("f"))
        .when(kind == "first_n", first("n"))
        .when(kind == "last", family)
        .otherwise(scrambled)
    )


def surrogates(units: DataFrame, key: str = KEY) -> DataFrame:
    """Adds `surrogate` to distinct rows (kind, plain): different ones, and no unit's own form."""
    units = stored(units.select("kind", "plain").distinct())
    waiting = units.withColumn("attempt", F.lit(0))
    settled: DataFrame | None = None
    while True:
        offered = stored(
            waiting.withColumn(
                "surrogate",
                surrogate_of(F.col("kind"), F.col("plain"), F.col("attempt"), key),
            )
        )
        real = units.select("kind", F.col("plain").alias("surrogate"))
        free = offered.join(real, ["kind", "surrogate"], "left_anti")
        if settled is not None:
            free = free.join(settled.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        won = free.groupBy("kind", "surrogate").agg(F.min("plain").alias("plain"))
        won = won.select("kind", "plain", "surrogate")
        settled = stored(won if settled is None else settled.union(won))
        waiting = offered.join(settled, ["kind", "plain"], "left_anti").select(
            "kind", "plain", (F.col("attempt") + 1).alias("attempt")
        )
        if waiting.isEmpty():
            return settled


def named_as(value: Column, surrogate: Column) -> Column:
    """A name's surrogate in the case of a mention."""
    return F.when(
        (value == F.upper(value)) & (value != F.lower(value)), F.upper(surrogate)
    ).otherwise(F.initcap(surrogate))


#: Capitalised words outside of entities, which may be names of the document.
BARE = rf"(?<![\p{{L}}\p{{N}}\p{{M}}]){WORD}"


def _lookup(names: Column, word: Column) -> Column:
    """The surrogate of a capitalised word, or null."""
    return named_as(word, F.element_at(names, plain_of(F.lit("last"), word)))


def _renamed(names: Column, word: Column) -> Column:
    """A capitalised word with its surrogate, or those of its parts, or null."""
    parts = F.transform(F.split(word, "-"), lambda w: F.struct(w.alias("w"), _lookup(names, w).alias("new")))
    by_parts = F.array_join(F.transform(parts, lambda p: F.coalesce(p["new"], p["w"])), "-")
    return F.coalesce(
        _lookup(names, word), F.when(F.exists(parts, lambda p: p["new"].isNotNull()), by_parts)
    )


def _bare(piece: Column, names: Column) -> Column:
    """A text between entities as (gap, word, new): `new` is null if the word is no name."""
    found = F.regexp_extract_all(piece, F.lit(BARE), F.lit(0))
    return F.zip_with(
        F.split(piece, BARE, -1),
        found,
        lambda gap, word: F.struct(gap.alias("gap"), word.alias("word"), _renamed(names, word).alias("new")),
    )


def written_as(value: Column, kind: Column, surrogate: Column) -> Column:
    """A surrogate in the form of a mention: its separators and its case."""
    # What stands before each letter or digit, and the letters themselves, follow the mention.
    places = F.sequence(F.lit(0), F.greatest(F.length(value) - 1, F.lit(0)))

    def add(state: Column, i: Column) -> Column:
        letter = F.substring(value, i + 1, F.lit(1))
        takes = letter.rlike(r"[\p{L}\p{N}]")
        new = F.substring(surrogate, state["n"] + 1, F.lit(1))
        new = F.when((letter != F.lower(letter)) & (new != ""), F.upper(new)).otherwise(new)
        return F.struct(
            F.concat(state["text"], F.when(takes, new).otherwise(letter)).alias("text"),
            (state["n"] + takes.cast("int")).alias("n"),
        )

    start = F.struct(F.lit("").alias("text"), F.lit(0).alias("n"))
    filled = F.aggregate(places, start, add)
    poured = F.concat(filled["text"], F.substring(surrogate, filled["n"] + 1, F.length(surrogate)))
    return (
        F.when(kind.startswith("first_") | (kind == "last"), named_as(value, surrogate))
        .when(kind == "initial", F.concat(F.initcap(surrogate), F.lit(".")))
        .when(kind.isin("ip", "secret", "domain", "mailbox"), surrogate)
        .otherwise(poured)
    )


def replaced(
    docs: DataFrame, key: str = "doc_id", text: str = "text", secret: str = KEY
) -> DataFrame:
    """The rows of `docs` with surrogates in the text, and `n_entities`, how many were replaced.

    A null text stays null, with 0 entities; texts without entities stay as they are. Repeated rows
    get the same text. A column `n_entities` that the rows have is replaced. An empty table gives an
    empty table.
    """
    entities = F.regexp_extract_all(docs[text], F.lit(PATTERN), F.lit(0))
    found = docs.select(
        docs[key].alias("_key"),
        F.xxhash64(docs[text]).alias("_tag"),
        # The outer form, or Spark adds a filter that looks for all entities a second time.
        F.posexplode_outer(entities).alias("_i", "_entity"),
    )
    mentions = stored(found.where(F.col("_entity").isNotNull()).distinct())
    each = (
        mentions.select("_entity")
        .distinct()
        .select("_entity", F.posexplode(parts_of(F.col("_entity"), form_of(F.col("_entity")))).alias("_at", "_p"))
        .select("_entity", "_at", "_p.kind", "_p.value")
    )
    parts = stored(each.withColumn("plain", F.when(F.col("kind").isNotNull(), plain_of(F.col("kind"), F.col("value")))))
    units = surrogates(parts.where(F.col("kind").isNotNull()), secret)
    shown = parts.join(units, ["kind", "plain"], "left").select(
        "_entity",
        "_at",
        F.when(F.col("kind").isNull(), F.col("value"))
        .otherwise(written_as(F.col("value"), F.col("kind"), F.col("surrogate")))
        .alias("_text"),
    )
    whole = shown.groupBy("_entity").agg(
        F.array_join(
            F.transform(F.sort_array(F.collect_list(F.struct("_at", "_text"))), lambda p: p["_text"]), ""
        ).alias("_new")
    )
    whole = stored(whole.withColumnRenamed("_entity", "_of"))
    filled = mentions.join(whole, F.col("_entity") == F.col("_of")).groupBy("_key", "_tag").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("_i", "_new"))), lambda m: m["_new"]).alias("_news"),
        F.sum(F.octet_length("_new") + 16).alias("_bytes"),
    )
    # The names of a document, by which it may call the same people without a title; family names first.
    own = (
        mentions.select("_key", "_tag", "_entity")
        .distinct()
        .join(
            parts.where(F.col("kind").startswith("first_") | (F.col("kind") == "last"))
            .where(F.length("plain") > 1)
            .select("_entity", "kind", "plain")
            .distinct(),
            "_entity",
        )
        .join(units, ["kind", "plain"])
        .groupBy("_key", "_tag", "plain")
        .agg(F.max(F.struct("kind", "surrogate"))["surrogate"].alias("surrogate"))
        .groupBy(F.col("_key").alias("_name_key"), F.col("_tag").alias("_name_tag"))
        .agg(
            F.map_from_entries(F.collect_list(F.struct("plain", "surrogate"))).alias("_names"),
            F.sum(F.octet_length("plain") + F.octet_length("surrogate") + 32).alias("_name_bytes"),
        )
    )
    filled = stored(
        filled.join(
            own, F.col("_key").eqNullSafe(F.col("_name_key")) & (F.col("_tag") == F.col("_name_tag")), "left"
        ).select("_key", "_tag", "_news", "_names", (F.col("_bytes") + F.coalesce("_name_bytes", F.lit(0))).alias("_bytes"))
    )
    size = filled.agg(F.coalesce(F.sum("_bytes"), F.lit(0)).alias("n")).first()["n"]
    known = measured_broadcast(filled.drop("_bytes"), 40 + int(size) // max(1, filled.count()))
    others = [c for c in docs.columns if c.lower() != "n_entities"]
    base = docs.select(*[docs[c] for c in others])
    near = base.join(
        known,
        base[key].eqNullSafe(known["_key"]) & (F.xxhash64(base[text]) == known["_tag"]),
        "left",
    )
    pieces = F.split(base[text], PATTERN, -1)
    # Of texts with names, each piece is cut once more, at its capitalised words.
    named = F.transform(
        pieces,
        lambda p: F.transform(
            F.array(_bare(p, known["_names"])),
            lambda cut: F.struct(
                F.array_join(
                    F.transform(cut, lambda c: F.concat(c["gap"], F.coalesce(c["new"], c["word"], F.lit("")))), ""
                ).alias("text"),
                F.size(F.filter(cut, lambda c: c["new"].isNotNull())).alias("n"),
            ),
        )[0],
    )
    plain = F.transform(pieces, lambda p: F.struct(p.alias("text"), F.lit(0).alias("n")))
    near = near.withColumn("_pieces", F.when(known["_news"].isNotNull(), F.when(known["_names"].isNotNull(), named).otherwise(plain)))
    put = F.array_join(
        F.transform("_pieces", lambda p, i: F.concat(p["text"], F.coalesce(F.get(known["_news"], i), F.lit("")))), ""
    )
    again = F.aggregate("_pieces", F.lit(0), lambda n, p: n + p["n"])
    new = F.when(known["_news"].isNull(), base[text]).otherwise(put)
    return near.select(
        *[(new if c == text else base[c]).alias(c) for c in others],
        F.coalesce(F.size(known["_news"]) + again, F.lit(0)).cast("long").alias("n_entities"),
    )
