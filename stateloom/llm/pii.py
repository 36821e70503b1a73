"""Format-preserving pseudonyms for personal data, in DataFrame expressions only.

Found values are validated, then permuted inside their own format by a keyed Feistel network over digits
or days. The permutation depends on the key and the kind alone, so equal values get equal pseudonyms in
every document and stay linked, and whoever has the key can invert it. Check digits are computed
anew, so a pseudonym validates like the value it replaces. Plans name the key's place, not the key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stateloom.llm.shared import free_name

ROUNDS = 8


def keyed(key: str | Column, kind: str, i: Column, value: Column, modulus: Column) -> Column:
    """The round function: 60 bits of a keyed digest, reduced."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), i.cast("string"), value.cast("string")), 256)
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint"), modulus)


def permuted(key: str | Column, kind: str, left: Column, right: Column, left_size: Column, right_size: Column) -> Column:
    """A keyed permutation of the pairs (left, right), left below left_size and right below right_size."""

    def one_round(pair: Column, i: Column) -> Column:
        a, b = pair["a"], pair["b"]
        to_left = F.pmod(a + keyed(key, kind, i, b, left_size), left_size)
        to_right = F.pmod(b + keyed(key, kind, i, a, right_size), right_size)
        even = i % 2 == 0
        return F.struct(F.when(even, to_left).otherwise(a).alias("a"), F.when(even, b).otherwise(to_right).alias("b"))

    start = F.struct(left.cast("bigint").alias("a"), right.cast("bigint").alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, one_round)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def permuted_text(key: str | Column, kind: str, text: Column) -> Column:
    """A keyed permutation of the texts of one format: digits, lower and upper case letters stay such, the rest stays."""

    def shifted(chars: Column, other: Column, i: Column) -> Column:
        digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), i.cast("string"), F.array_join(other, "")), 512)

        def shift(c: Column, j: Column) -> Column:
            step, code = F.conv(F.substring(digest, (j * 2) % 128 + 1, F.lit(2)), 16, 10).cast("int"), F.ascii(c)
            turned = lambda first, n: F.char(first + (code - first + step) % n)
            return (
                F.when(code.between(48, 57), turned(48, 10)).when(code.between(97, 122), turned(97, 26))
                .when(code.between(65, 90), turned(65, 26)).otherwise(c)
            )

        return F.transform(chars, shift)

    def one_round(pair: Column, i: Column) -> Column:
        a, b, even = pair["a"], pair["b"], i % 2 == 0
        return F.struct(F.when(even, shifted(a, b, i)).otherwise(a).alias("a"), F.when(even, b).otherwise(shifted(b, a, i)).alias("b"))

    chars = F.split(text, "")
    half = F.floor(F.size(chars) / 2).cast("int")
    start = F.struct(F.slice(chars, F.lit(1), half).alias("a"), F.slice(chars, half + 1, F.size(chars)).alias("b"))
    rounds = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, one_round)
    return let(rounds, lambda p: F.concat(F.array_join(p["a"], ""), F.array_join(p["b"], "")))


def luhn_sum(digits: Column, doubled: int) -> Column:
    """The Luhn sum that doubles, from the right, the last digit and every second (0) or the others (1)."""
    values = F.transform(F.reverse(F.split(digits, "")), lambda c: c.cast("int"))
    turned = F.transform(values, lambda d, i: F.when(i % 2 == doubled, d * 2 - F.when(d > 4, 9).otherwise(0)).otherwise(d))
    return F.aggregate(turned, F.lit(0), lambda s, d: s + d)


def mod97(text: Column) -> Column:
    """The remainder by 97 of a text of digits and letters, letters counting from 10."""
    value = lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
    step = lambda s, v: (s * F.when(v > 9, 100).otherwise(10) + v) % 97
    return F.aggregate(F.transform(F.split(text, ""), value), F.lit(0), step)


def refilled(text: Column, inner: Column, signs: str = "[0-9]") -> Column:
    """`text` with those of its characters that match `signs` replaced by those of `inner`, in order."""

    def put(state: Column, c: Column) -> Column:
        hit = c.rlike(signs)
        return F.struct(
            F.concat(state["out"], F.when(hit, F.substring(inner, state["next"], F.lit(1))).otherwise(c)).alias("out"),
            (state["next"] + hit.cast("int")).alias("next"),
        )

    return F.aggregate(F.split(text, ""), F.struct(F.lit("").alias("out"), F.lit(1).alias("next")), put)["out"]


# -- kinds: each takes a found text and gives its pseudonym, or the text itself where it does not validate


def email(key: str | Column, text: Column) -> Column:
    """The local part is permuted, the domain stays."""
    name = F.substring_index(text, "@", 1)
    return F.concat(permuted_text(key, "email", name), F.substring(text, F.length(name) + 1, F.length(text)))


def card(key: str | Column, text: Column) -> Column:
    """A number with a valid Luhn digit; the issuer's first digit stays."""

    def new(digits: Column) -> Column:
        body = permuted_text(key, "card", F.substring(digits, F.lit(2), F.length(digits) - 2))
        moved = let(F.concat(F.substring(digits, 1, 1), body), lambda m: F.concat(m, ((10 - luhn_sum(m, 0) % 10) % 10).cast("string")))
        return F.when(luhn_sum(digits, 1) % 10 == 0, refilled(text, moved)).otherwise(text)

    return let(F.regexp_replace(text, "[^0-9]", ""), new)


# Country codes of one and two digits; all others have three.
SHORT_CODES = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98"
COUNTRY = rf"^\+(?:{SHORT_CODES.replace(' ', '|')}|[0-9]{{1,3}})(?:[ -]?\(0\))?"


def phone(key: str | Column, text: Column) -> Column:
    """An international number of 8 to 15 digits; its country code stays, and a (0) behind it."""

    def new(parts: Column) -> Column:
        code, rest = F.element_at(parts, 1), F.element_at(parts, 2)
        moved = permuted_text(key, "phone", F.regexp_replace(rest, "[^0-9]", ""))
        return F.concat(code, refilled(rest, moved))

    code = F.regexp_extract(text, COUNTRY, 0)
    parts = let(code, lambda c: F.array(c, F.substring(text, F.length(c) + 1, F.length(text))))
    return F.when(F.length(F.regexp_replace(text, "[^0-9]", "")).between(8, 15), let(parts, new)).otherwise(text)


# How long the account numbers of a country are.
IBAN_LENGTHS = (
    " AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 ES24 FI18 FK18 FO18 FR27"
    " GB22 GE22 GI23 GL18 GR27 GT28 HN28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22"
    " MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 SI19 SK24 SM27 SO23 ST25 SV28"
    " TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30"
)


def valid_iban(bare: Column) -> Column:
    return (F.length(bare) >= 12) & (mod97(F.concat(F.substring(bare, F.lit(5), F.length(bare)), F.substring(bare, 1, 4))) == 1)


def iban_in(text: Column) -> Column:
    """What of `text` is an account number: the valid beginning as long as its country's numbers, else the longest
    valid one that ends with a word, else all of it."""

    def chosen(parts: Column) -> Column:
        beginnings = F.transform(F.sequence(F.size(parts), F.lit(1), F.lit(-1)), lambda k: F.array_join(F.slice(parts, F.lit(1), k), " "))
        bare = lambda b: F.replace(b, F.lit(" "))
        usual = F.substring(F.split_part(F.lit(IBAN_LENGTHS), F.concat(F.lit(" "), F.substring(text, 1, 2)), F.lit(2)), 1, 2).try_cast("int")
        valid = F.filter(beginnings, lambda b: valid_iban(bare(b)))
        return let(valid, lambda v: F.coalesce(F.get(F.filter(v, lambda b: F.length(bare(b)) == usual), F.lit(0)), F.get(v, F.lit(0)), text))

    return let(F.split(text, " "), chosen)


def iban(key: str | Column, text: Column) -> Column:
    """An account number that leaves 1 by 97; the country stays, the check digits follow from the rest."""

    def new(bare: Column) -> Column:
        country, account = F.substring(bare, 1, 2), F.substring(bare, F.lit(5), F.length(bare))
        moved = let(permuted_text(key, "iban", account), lambda m: F.concat(
            country, F.lpad((98 - mod97(F.concat(m, country, F.lit("00")))).cast("string"), 2, "0"), m
        ))
        return F.when(valid_iban(bare), refilled(text, moved, "[0-9A-Z]")).otherwise(text)

    return let(F.replace(text, F.lit(" ")), new)


def social_security(key: str | Column, text: Column) -> Column:
    """Area 001 to 665 or 667 to 899, group and serial not zero: permuted among all of these of the same run of areas."""

    def new(p: Column) -> Column:
        area, group, serial = (F.element_at(p, k).cast("bigint") for k in (1, 2, 3))
        rest = (group - 1) * 9999 + serial - 1
        shown = lambda first, pair: let(pair, lambda q: F.concat_ws(
            "-", F.lpad((q["a"] + first).cast("string"), 3, "0"), F.lpad((F.floor(q["b"] / 9999) + 1).cast("string"), 2, "0"),
            F.lpad((q["b"] % 9999 + 1).cast("string"), 4, "0"),
        ))
        low = shown(1, permuted(key, "ssn", area - 1, rest, F.lit(665), F.lit(99 * 9999)))
        high = shown(667, permuted(key, "ssn 667", area - 667, rest, F.lit(233), F.lit(99 * 9999)))
        stays = (group == 0) | (serial == 0)
        return F.when(stays, text).when(area.between(1, 665), low).when(area.between(667, 899), high).otherwise(text)

    return let(F.split(text, "-"), new)


def ip_address(key: str | Column, text: Column) -> Column:
    """Four numbers up to 255: permuted among all addresses."""

    def new(p: Column) -> Column:
        byte = [F.element_at(p, k).cast("bigint") for k in (1, 2, 3, 4)]
        pair = permuted(key, "ip", byte[0] * 256 + byte[1], byte[2] * 256 + byte[3], F.lit(65536), F.lit(65536))
        made = let(pair, lambda q: F.concat_ws(
            ".", *[x.cast("bigint").cast("string") for x in (F.floor(q["a"] / 256), q["a"] % 256, F.floor(q["b"] / 256), q["b"] % 256)]
        ))
        return F.when(F.greatest(*byte) <= 255, made).otherwise(text)

    return let(F.split(text, r"\."), new)


# 36524 days from 1900 to 1999 are 92 x 397, and 36525 from 2000 to 2099 are 75 x 487.
CENTURIES = (("1900-01-01", 92, 397), ("2000-01-01", 75, 487))


def moved_day(key: str | Column, day: Column) -> Column:
    """A permutation of the days of the 20th century, and one of those of the 21st; other days stay."""

    def within(first: str, left: int, right: int) -> Column:
        number = F.datediff(day, F.lit(first).cast("date"))
        pair = permuted(key, f"day {first}", F.floor(number / right), number % right, F.lit(left), F.lit(right))
        return let(pair, lambda q: F.date_add(F.lit(first).cast("date"), (q["a"] * right + q["b"]).cast("int")))

    (first, *a), (second, *b) = CENTURIES
    return F.when(F.year(day).between(1900, 1999), within(first, *a)).when(F.year(day).between(2000, 2099), within(second, *b)).otherwise(day)


def date(key: str | Column, text: Column) -> Column:
    """A date that exists, as 2001-12-31, 31.12.2001, 31/12/2001 or 12/31/2001 (day first where both fit)."""
    tried = F.array(*[
        F.struct(F.try_to_date(text, form).alias("day"), F.lit(form).alias("form"))
        for form in ("yyyy-MM-dd", "dd.MM.yyyy", "dd/MM/yyyy", "MM/dd/yyyy")
    ])
    first = F.element_at(F.filter(tried, lambda x: x["day"].isNotNull()), 1)

    def new(found: Column) -> Column:
        d = moved_day(key, found["day"])
        shown = let(d, lambda m: F.when(found["form"] == "yyyy-MM-dd", F.date_format(m, "yyyy-MM-dd")).when(
            found["form"] == "dd.MM.yyyy", F.date_format(m, "dd.MM.yyyy")).when(
            found["form"] == "dd/MM/yyyy", F.date_format(m, "dd/MM/yyyy")).otherwise(F.date_format(m, "MM/dd/yyyy")))
        return F.coalesce(shown, text)

    return F.when(F.size(F.filter(tried, lambda x: x["day"].isNotNull())) > 0, let(first, new)).otherwise(text)


# Country codes by the least and the most digits that follow them, where these are few. Other
# codes take from 8 to 15 digits in all.
PHONE_DIGITS = {
    (8, 8): "45 47 65 386 852", (9, 9): "27 31 33 34 40 41 48 56 61 351 380 420 421", (10, 10): "1 7 30 52 57 90 91",
    (8, 9): "32 36 51 66 385 886 966 971 972", (9, 10): "44 81 84 92", (8, 10): "20 60 63 64 82", (10, 11): "54 55 86",
}
IP = r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}"
DATE = r"(?:(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.(?:19|20)[0-9]{2}|[0-9]{2}/[0-9]{2}/(?:19|20)[0-9]{2})"
SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"
CARD = r"(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})"


def digits_before(least: int) -> str:
    """Written out, as a look-behind takes no repeated group."""
    one, more = "[ .()-]{0,2}[0-9]", ""
    for _ in range(15 - least):
        more = f"(?:{one}{more})?"
    return rf"(?<=\+{one * least}{more})"


def phone_pattern() -> str:
    """An international number that ends where the next value begins.

    Where the country fixes how many digits follow, these are taken. Elsewhere groups follow up to 15 digits, but no group
    that begins an address, a date, a social security or card number, nor, once 10 digits are there, a
    year or a number of five digits and more (from 7 digits on after 8). If nothing is a number that way, the groups decide.
    """
    end = r"(?![0-9A-Za-z]|\.[0-9])"
    value = rf" (?:{IP}{end}|{DATE}{end}|{SSN}(?![0-9A-Za-z-]))"
    further = rf"{digits_before(10)} (?:(?:19|20)[0-9]{{2}}|[0-9]{{5,}})(?![0-9A-Za-z])|{digits_before(8)} [0-9]{{7,}}| {CARD}(?![0-9A-Za-z])"
    between = r"(?:\)[ -]?|[ -]?\(|[ .-])"
    word = r"(?:[0-9A-WYZa-wyz]|[xX](?![0-9]{1,6}(?![0-9A-Za-z])))"  # what must not follow: anything but an extension, x12
    planned = "|".join(
        rf"(?:{codes.replace(' ', '|')})(?:[ -]?\(0\))?{between}?[0-9](?:(?:(?!{value}){between})?[0-9]){{{least - 1},{most - 1}}}(?!{word})"
        for (least, most), codes in PHONE_DIGITS.items()
    )
    start = r"[0-9]{1,3}[ -]?(?:\([0-9]{1,4}\)[ -]?)?[0-9]{2,4}"
    bounded = rf"{start}(?:(?!{value}|{further})[ .-]?[0-9]{{2,4}}){{1,4}}(?!{word}){digits_before(8)}"
    grouped = rf"{start}(?:[ .-]?[0-9]{{2,4}}){{1,4}}(?!{word}|[./-][0-9]){digits_before(8)}"
    return rf"(?<![0-9A-Za-z+])\+(?:{planned}|{bounded}|{grouped})"


# The kinds in the order in which they are tried, and what each looks like. A match begins
# and ends at a word's edge, and every repetition is bounded, so that long runs cost no more than their length.
KINDS: dict[str, tuple[str, Callable[[str | Column, Column], Column]]] = {
    "email": (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}", email),
    "phone": (phone_pattern(), phone),
    "ip": (rf"(?<![0-9A-Za-z.]){IP}(?![0-9A-Za-z]|\.[0-9])", ip_address),
    "date": (rf"(?<![0-9A-Za-z./-]){DATE}(?![0-9A-SU-Za-z]|T(?![0-9]{{2}}:[0-9]{{2}})|[./-][0-9])", date),
    "ssn": (rf"(?<![0-9A-Za-z-]){SSN}(?![0-9A-Za-z-])", social_security),
    "card": (rf"(?<![0-9A-Za-z]){CARD}(?![0-9A-Za-z])", card),
    "iban": (r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])", iban),
}
ANY = "|".join(pattern for pattern, _ in KINDS.values())
# a phone's end depends on what follows it in the text, so a found one is told by its beginning
SHAPES = {name: r"^\+[^@]*$" if name == "phone" else f"^(?:{pattern})$" for name, (pattern, _) in KINDS.items()}
BLOCK = 256


def pseudonym(key: str | Column, found: Column) -> Column:
    """What of a found text is a value (`value`), and its pseudonym (`new`); both equal where it does not validate."""

    def new(value: Column) -> Column:
        out = value
        for name, (_, kind) in reversed(KINDS.items()):
            out = F.when(value.rlike(SHAPES[name]), kind(key, value)).otherwise(out)
        return F.struct(value.alias("value"), out.alias("new"))

    return let(F.when(found.rlike(SHAPES["iban"]), iban_in(found)).otherwise(found), new)


def replaced(key: str | Column, text: Column) -> Column:
    """`text` with every validated value replaced, and how many were. For texts that match ANY.

    Every place where a value may begin is tried, from left to right; the search goes on behind a
    replaced value, and behind the first sign of one that does not validate. Blocks keep the joining linear.
    """
    led = F.concat(F.lit("\n"), text)  # so that the first piece is what stands before the first place
    pieces, found = F.split(led, f"(?={ANY})", -1), F.regexp_extract_all(led, F.lit(f"(?=({ANY}))"), F.lit(1))
    tried = F.transform(found, lambda m: pseudonym(key, m))

    def step(state: Column, at: Column) -> Column:
        piece, size = at["piece"], F.length(at["piece"])
        hit = (state["over"] == 0) & (at["tried"]["new"] != at["tried"]["value"])
        over = F.when(hit, F.length(at["tried"]["value"])).otherwise(state["over"])
        return F.struct(
            F.concat(state["out"], F.when(hit, at["tried"]["new"]).otherwise(""), F.substring(piece, over + 1, size)).alias("out"),
            F.greatest(over - size, F.lit(0)).alias("over"), (state["n"] + hit.cast("int")).alias("n"),
        )

    def block(state: Column, steps: Column) -> Column:
        inner = F.aggregate(steps, F.struct(F.lit("").alias("out"), state["over"].alias("over"), state["n"].alias("n")), step)
        return let(inner, lambda i: F.struct(F.concat(state["out"], i["out"]).alias("out"), i["over"].alias("over"), i["n"].alias("n")))

    def walked(p: Column) -> Column:
        steps = F.zip_with(F.slice(p, F.lit(2), F.size(p)), tried, lambda piece, t: F.struct(piece.alias("piece"), t.alias("tried")))
        start = F.struct(F.element_at(p, 1).alias("out"), F.lit(0).alias("over"), F.lit(0).alias("n"))
        blocks = let(steps, lambda s: F.transform(F.sequence(F.lit(1), F.size(s), F.lit(BLOCK)), lambda k: F.slice(s, k, F.lit(BLOCK))))
        return F.aggregate(blocks, start, block)

    return let(let(pieces, walked), lambda w: F.struct(F.substring(w["out"], F.lit(2), F.length(w["out"])).alias("text"), w["n"].alias("n")))


def pseudonymised(key: str | Column, text: Column) -> Column:
    """`text` with every validated value replaced; null stays null, a text without any stays as it is.

    A key that is given as text stands in the plan; `hide_personal_data` keeps it out.
    """
    return F.when(text.rlike(ANY), replaced(key, text)["text"]).otherwise(text)


def count_replaced(key: str | Column, text: Column) -> Column:
    """How many values of a text have a pseudonym that differs from them; 0 for null."""
    return F.when(text.rlike(ANY), replaced(key, text)["n"]).otherwise(0).cast("long")


def with_pseudonyms(documents: DataFrame, key: str, text: str, found: str) -> DataFrame:
    """`documents` and a column `found`: the text with every validated value replaced, and how many were (text, n).

    Null stays null with 0, a text without any value stays as it is. The key is looked up by a scalar subquery, so that
    neither plans nor event logs show it; text and count come from one evaluation.
    """
    secret = free_name(documents, "secret")
    looked_up = documents.sparkSession.sql("select * from values (:key) as t(key)", args={"key": key}).scalar()
    column = F.col(f"`{text.replace('`', '``')}`")
    none = F.struct(column.alias("text"), F.lit(0).alias("n"))
    hidden = F.when(column.rlike(ANY), replaced(F.col(secret), column)).otherwise(none)
    return documents.withColumn(secret, looked_up).withColumn(found, hidden).drop(secret)


def hide_personal_data(documents: DataFrame, key: str, text: str = "text") -> DataFrame:
    """`documents`, all columns, with pseudonyms in `text`. Repeated rows get equal pseudonyms."""
    found = free_name(documents, "found")
    return with_pseudonyms(documents, key, text, found).withColumn(text, F.col(f"{found}.text")).drop(found)
