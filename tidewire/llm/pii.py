"""Format-preserving pseudonyms for personal data: keyed Feistel permutations in SQL functions.

A value found and validated in a text is replaced by another of the same format:
digits by digits, letters by letters, separators kept, check digits made right.
The permutation depends on the key and the kind only, so equal values stay equal
in all documents and different values stay different.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEY = "demonstration key"  # a parameter; production passes its own secret
ROUNDS = 8
ANALYZER_STEPS = 500  # Spark resolves about one level of nested lambdas a step; its default of 100 is too few

_EMAIL = r"[A-Za-z0-9_%+][A-Za-z0-9._%+-]{0,63}+@[A-Za-z0-9][A-Za-z0-9-]{0,62}(?:\.[A-Za-z0-9-]{1,63}){0,6}\.[A-Za-z]{2,24}(?![A-Za-z0-9-])"
_SECRET = r"(?i:\b(?:password|passwd|secret|token|api[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?)[A-Za-z0-9_\-]{8,}+"
_IBAN_RUN = r"\b[A-Z]{2}[0-9]{2}[A-Z0-9 ]{10,}[A-Z0-9]\b"  # may go on into other words and numbers
_IP = r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])"
_ISO_DATE = r"(?<![0-9-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9]|-[0-9])"
_DOT_DATE = r"(?<![0-9./])[0-9]{2}[./][0-9]{2}[./][0-9]{4}(?![0-9]|[./][0-9])"
_SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])"
_PHONE = r"(?<![0-9+])\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9])"
_LOCAL_PHONE = r"(?<![0-9+(.-])(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9]|-[0-9])"
_CARD_RUN = r"(?<![0-9])[0-9][0-9 -]{11,}[0-9]"  # may hold other numbers as well
_CARD_GROUPS = r"^([0-9]{13,19}|[0-9]{4}([ -][0-9]{4}){3}([ -][0-9]{1,3})?|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5})$"

_NAMED = {"secret": _SECRET, "email": _EMAIL}
_NUMBERS = {"ip": _IP, "iso_date": _ISO_DATE, "dot_date": _DOT_DATE, "ssn": _SSN, "phone": _PHONE, "local_phone": _LOCAL_PHONE}
KINDS = _NAMED | {"iban": _IBAN_RUN} | _NUMBERS | {"card": _CARD_RUN}
PATTERN = "|".join(f"(?:{p})" for p in KINDS.values())

_IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FO FI GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC", 33: "RU",
}
_IBAN_LENGTH = {country: n for n, countries in _IBAN_LENGTHS.items() for country in countries.split()}

# 1900-01-01 to 2099-12-31 has 73,049 = 319 * 229 days, so two mixed-radix halves permute it exactly.
_DAYS_HIGH, _DAYS_LOW, _FIRST_DAY = 319, 229, "1900-01-01"


def _bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is read."""
    return F.get(F.transform(F.array(value), use), 0)


def _hash(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", *parts), 512)


def _number(stream: Column, digits: int = 12) -> Column:
    return F.conv(F.substring(stream, 1, digits), 16, 10).cast("bigint")


def _shift(half: Column, stream: Column) -> Column:
    """Every digit, lower-case or upper-case letter moved within its class; the rest as it is."""

    def one(c: Column, i: Column) -> Column:
        code = F.ascii(c)
        k = F.conv(F.substring(stream, 2 * (i % 64) + 1, F.lit(2)), 16, 10).cast("int")
        move = lambda first, n: F.char(F.lit(first) + (code - first + k) % n)
        return (
            F.when(c.between("0", "9"), move(48, 10))
            .when(c.between("a", "z"), move(97, 26))
            .when(c.between("A", "Z"), move(65, 26))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(half, ""), one), "")


def permute_text(value: Column, key: str, kind: str) -> Column:
    """Keyed permutation of the strings of one format: equal length, each character in its own class.

    A Feistel network over the two halves: in turn, one half is shifted by a
    keyed hash of the other, which any reader of the key can undo.
    """
    length = F.length(value)
    cut = F.floor(length / 2).cast("int")
    state = F.struct(F.substring(value, F.lit(1), cut).alias("l"), F.substring(value, cut + 1, length).alias("r"))

    def step(s: Column, i: Column) -> Column:
        stream = lambda other: _hash(F.lit(key), F.lit(kind), i.cast("string"), other)
        left = F.when(i % 2 == 1, _shift(s["l"], stream(s["r"]))).otherwise(s["l"])
        right = F.when(i % 2 == 0, _shift(s["r"], stream(s["l"]))).otherwise(s["r"])
        return F.struct(left.alias("l"), right.alias("r"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), state, step, lambda s: F.concat(s["l"], s["r"]))


def permute_number(value: Column, high: int, low: int, key: str, kind: str) -> Column:
    """Keyed permutation of 0 .. high * low - 1."""
    state = F.struct(F.floor(value / low).cast("bigint").alias("l"), (value % low).cast("bigint").alias("r"))

    def step(s: Column, i: Column) -> Column:
        stream = lambda other: _number(_hash(F.lit(key), F.lit(kind), i.cast("string"), other.cast("string")))
        left = F.when(i % 2 == 1, (s["l"] + stream(s["r"])) % high).otherwise(s["l"])
        right = F.when(i % 2 == 0, (s["r"] + stream(s["l"])) % low).otherwise(s["r"])
        return F.struct(left.alias("l"), right.alias("r"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), state, step, lambda s: s["l"] * low + s["r"])


def _luhn_sum(digits: Column) -> Column:
    """Luhn sum; the last digit is the check digit."""
    n = F.length(digits)
    return F.aggregate(
        F.sequence(F.lit(1), n), F.lit(0),
        lambda a, i: a + _bind(
            F.substring(digits, i, F.lit(1)).cast("int") * F.when((n - i) % 2 == 1, 2).otherwise(1),
            lambda d: d - F.when(d > 9, 9).otherwise(0),
        ),
    )


def _refill(template: Column, values: Column) -> Column:
    """Puts the letters and digits of ``values``, in order, where ``template`` has letters or digits."""
    at = lambda i: F.length(F.regexp_replace(F.substring(template, F.lit(1), i + 1), "[^A-Za-z0-9]", ""))
    return F.array_join(
        F.transform(
            F.split(template, ""),
            lambda c, i: F.when(c.rlike("[A-Za-z0-9]"), F.substring(values, at(i), F.lit(1))).otherwise(c),
        ), "",
    )


def _card(m: Column, key: str) -> Column:
    digits = F.regexp_replace(m, "[^0-9]", "")
    body = permute_text(F.substring(digits, F.lit(1), F.length(digits) - 1), key, "card")
    whole = _bind(body, lambda b: F.concat(b, ((10 - _luhn_sum(F.concat(b, F.lit("0"))) % 10) % 10).cast("string")))
    return _bind(whole, lambda w: _refill(m, w))


def _mod97(text: Column) -> Column:
    """Remainder by 97 of an IBAN's letters and digits, country and check digits moved to the end."""
    turned = F.concat(F.substring(text, F.lit(5), F.length(text)), F.substring(text, 1, 4))
    return F.aggregate(
        F.split(turned, ""), F.lit(0),
        lambda a, c: F.when(c.between("0", "9"), (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97),
    )


def _iban(m: Column, key: str) -> Column:
    plain = F.replace(m, F.lit(" "), F.lit(""))
    body = permute_text(F.substring(plain, F.lit(5), F.length(plain)), key, "iban")

    def build(b: Column) -> Column:
        country = F.substring(plain, 1, 2)
        check = 98 - _mod97(F.concat(country, F.lit("00"), b))
        return F.concat(country, F.lpad(check.cast("string"), 2, "0"), b)

    return _bind(_bind(body, build), lambda w: _refill(m, w))


def _ip(m: Column, key: str) -> Column:
    octets = F.split(m, r"\.").cast("array<bigint>")
    value = F.aggregate(octets, F.lit(0).cast("bigint"), lambda a, o: a * 256 + o)
    return _bind(
        permute_number(value, 65536, 65536, key, "ip"),
        lambda v: F.array_join(F.transform(F.array(*map(F.lit, (24, 16, 8, 0))), lambda s: F.floor(v / F.pow(F.lit(2), s)).cast("bigint") % 256), "."),
    )


def _day(m: Column, kind: str) -> Column:
    if kind == "iso_date":
        return F.try_to_timestamp(m, F.lit("yyyy-MM-dd")).cast("date")
    slash = F.try_to_timestamp(m, F.lit("MM/dd/yyyy")).cast("date")
    return F.coalesce(slash, F.try_to_timestamp(F.translate(m, "./", ".."), F.lit("dd.MM.yyyy")).cast("date"))


def _date(m: Column, key: str, kind: str) -> Column:
    """Another day of 1900 to 2099, written in the same way; other days stay. Slashes are read month first."""
    day = _day(m, kind)
    offset = F.datediff(day, F.lit(_FIRST_DAY).cast("date")).cast("bigint")
    size = _DAYS_HIGH * _DAYS_LOW
    moved = F.date_add(F.lit(_FIRST_DAY).cast("date"), permute_number(offset, _DAYS_HIGH, _DAYS_LOW, key, "date").cast("int"))
    if kind == "iso_date":
        shown = lambda d: F.date_format(d, "yyyy-MM-dd")
    else:
        month_first = F.try_to_timestamp(m, F.lit("MM/dd/yyyy")).isNotNull()
        shown = lambda d: F.when(month_first, F.date_format(d, "MM/dd/yyyy")).otherwise(
            F.replace(F.date_format(d, "dd.MM.yyyy"), F.lit("."), F.substring(m, 3, 1))
        )
    return F.when(offset.between(0, size - 1), _bind(moved, shown)).otherwise(m)


def _secret(m: Column, key: str) -> Column:
    head = F.regexp_extract(m, r"(?is)^(\w[\w-]*\s*[=:]\s*[\"']?)", 1)
    return F.concat(head, permute_text(F.substring(m, F.length(head) + 1, F.length(m)), key, "secret"))


def _email(m: Column, key: str) -> Column:
    local = F.regexp_extract(m, "^([^@]*)@", 1)
    return F.concat(permute_text(local, key, "email"), F.substring(m, F.length(local) + 1, F.length(m)))


def _phone(m: Column, key: str) -> Column:
    code = F.regexp_extract(m, r"^(\+[0-9]{1,3}(?=[ .(-]))", 1)
    rest = F.substring(m, F.length(code) + 1, F.length(m))
    return _bind(
        permute_text(F.regexp_replace(rest, "[^0-9]", ""), key, "phone"), lambda d: F.concat(code, _refill(rest, d))
    )


def _is(kind: str, m: Column) -> Column:
    return m.rlike(f"(?s)\\A(?:{KINDS[kind]})\\z")


def _pseudonym(m: Column, key: str) -> Column:
    """The pseudonym of a match of one of ``_NAMED`` or ``_NUMBERS``, or null if it is no valid value."""
    digits = F.regexp_replace(m, "[^0-9]", "")
    octets_fit = F.forall(F.split(m, r"\."), lambda o: (o.cast("int") < 256) & ((F.length(o) == 1) | ~o.startswith("0")))
    return (
        F.when(_is("secret", m), _secret(m, key))
        .when(_is("email", m), _email(m, key))
        .when(_is("ip", m), F.when(octets_fit, _ip(m, key)))
        .when(_is("iso_date", m), _date(m, key, "iso_date"))
        .when(_is("dot_date", m), _date(m, key, "dot_date"))
        .when(_is("ssn", m), F.when(m.rlike("^(?!000|666|9)...-(?!00)..-(?!0000)"), _refill(m, permute_text(digits, key, "ssn"))))
        .when(_is("phone", m) | _is("local_phone", m), _phone(m, key))
    )


# A text under way is an array of strings: plain ones at even places, pseudonyms at odd places between them.
_PARTS = "array<string>"


def _parts_of(pairs: Column) -> Column:
    """Parts of ``pairs`` (plain, kept, new): the plain strings, each followed by a pseudonym, or by ``kept`` where that is null."""
    start = F.struct(F.array().cast(_PARTS).alias("done"), F.lit("").alias("open"))

    def step(state: Column, x: Column) -> Column:
        text = F.concat(state["open"], x["plain"])
        return F.when(x["new"].isNull(), F.struct(state["done"].alias("done"), F.concat(text, x["kept"]).alias("open"))).otherwise(
            F.struct(F.concat(state["done"], F.array(text, x["new"])).alias("done"), F.lit("").alias("open"))
        )

    return F.aggregate(pairs, start, step, lambda state: F.concat(state["done"], F.array(state["open"])))


def _pass(parts: Column, pattern: str, expand) -> Column:
    """``expand`` of every plain part in which ``pattern`` is found."""
    return F.flatten(F.transform(parts, lambda s, i: F.when((i % 2 == 0) & s.rlike(pattern), expand(s)).otherwise(F.array(s))))


def _values_pass(parts: Column, kinds: dict, key: str) -> Column:
    pattern = "|".join(f"(?:{p})" for p in kinds.values())

    def expand(s: Column) -> Column:
        pairs = F.zip_with(
            F.split(s, pattern, -1), F.regexp_extract_all(s, F.lit(pattern), F.lit(0)),
            lambda p, m: F.struct(p.alias("plain"), F.coalesce(m, F.lit("")).alias("kept"), _pseudonym(m, key).alias("new")),
        )
        return _parts_of(pairs)

    return _pass(parts, pattern, expand)


def _runs_pass(parts: Column, pattern: str, rank, new) -> Column:
    """Within each run that ``pattern`` finds, the words that together make a valid value, from the left.

    A run's words have their separators after them. ``rank(value, whole run)`` is
    null for what is no value; of those that start at a word the highest is
    taken, then the longest.
    """

    def values(run: Column) -> Column:
        words = F.regexp_extract_all(run, F.lit("[A-Z0-9]+[ -]*"), F.lit(0))

        def search(words: Column) -> Column:
            def step(state: Column, i: Column) -> Column:
                text_to = lambda j: F.regexp_replace(F.array_join(F.slice(words, i, j - i + 1), ""), "[ -]+$", "")
                ends = F.sequence(i, F.least(F.size(words), i + 33))
                tried = F.transform(ends, lambda j: _bind(text_to(j), lambda v: F.struct(rank(v, run).alias("rank"), j.alias("j"), v.alias("v"))))
                best = F.array_max(F.filter(tried, lambda x: x["rank"].isNotNull()))
                word = F.get(words, i - 1)

                def move(x: Column) -> Column:
                    gap = F.regexp_extract(F.get(words, x["j"] - 1), "([ -]*)$", 1)
                    taken = F.array(
                        F.struct(F.lit("").alias("plain"), F.lit("").alias("kept"), new(x["v"]).alias("new")),
                        F.struct(gap.alias("plain"), F.lit("").alias("kept"), F.lit(None).cast("string").alias("new")),
                    )
                    left = F.array(F.struct(word.alias("plain"), F.lit("").alias("kept"), F.lit(None).cast("string").alias("new")))
                    return F.when(x.isNull(), F.struct(F.concat(state["out"], left).alias("out"), (i + 1).alias("next"))).otherwise(
                        F.struct(F.concat(state["out"], taken).alias("out"), (x["j"] + 1).alias("next"))
                    )

                return F.when(i < state["next"], state).otherwise(_bind(best, move))

            start = F.struct(F.array().cast("array<struct<plain:string,kept:string,new:string>>").alias("out"), F.lit(1).alias("next"))
            return F.aggregate(F.sequence(F.lit(1), F.size(words)), start, step, lambda state: state["out"])

        return _bind(words, search)

    def expand(s: Column) -> Column:
        plain = lambda p: F.array(F.struct(p.alias("plain"), F.lit("").alias("kept"), F.lit(None).cast("string").alias("new")))
        return _parts_of(F.flatten(F.zip_with(
            F.split(s, pattern, -1), F.regexp_extract_all(s, F.lit(pattern), F.lit(0)),
            lambda p, run: F.when(run.isNull(), plain(p)).otherwise(F.concat(plain(p), values(run))),
        )))

    return _pass(parts, pattern, expand)


def _iban_rank(v: Column, run: Column) -> Column:
    """2 with the length of its country, 1 with another, null if it is no valid number."""
    lengths = F.create_map(*[F.lit(x) for pair in _IBAN_LENGTH.items() for x in pair])
    plain = F.replace(v, F.lit(" "), F.lit(""))
    right = F.coalesce(F.try_element_at(lengths, F.substring(v, 1, 2)) == F.length(plain), F.lit(False))
    formed = v.rlike("^[A-Z]{2}[0-9]{2}") & ~v.contains("  ") & F.length(plain).between(15, 34)
    return F.when(formed, F.when(_mod97(plain) == 1, F.when(right, 2).otherwise(1)))


def _card_rank(grouped: bool):
    """The whole run first, then what is grouped like a card, then, if not ``grouped``, any words."""

    def rank(v: Column, run: Column) -> Column:
        digits = F.regexp_replace(v, "[ -]", "")
        level = F.when(v == run, 3).when(v.rlike(_CARD_GROUPS), 2).otherwise(F.lit(None).cast("int") if grouped else F.lit(1))
        formed = F.length(digits).between(13, 19) & ~v.rlike("[ -]{2}") & level.isNotNull()
        return F.when(formed, F.when(_luhn_sum(digits) % 10 == 0, level))

    return rank


def pseudonymize(text: Column, key: str = KEY) -> Column:
    """The text with every valid value replaced; a null text stays null.

    Texts without a digit or an ``@`` are passed through after one look. The
    others are searched kind by kind in what the kinds before have left, so a
    run that is no value as a whole, or holds two, hides none: cards grouped as
    usual come before, other cards after the numbers that may stand beside them.
    """
    conf = SparkSession.active().conf
    conf.set("spark.sql.analyzer.maxIterations", max(ANALYZER_STEPS, int(conf.get("spark.sql.analyzer.maxIterations"))))
    parts = _values_pass(F.array(text), _NAMED, key)
    parts = _runs_pass(parts, _IBAN_RUN, _iban_rank, lambda v: _iban(v, key))
    parts = _runs_pass(parts, r"(?<![0-9+])" + _CARD_RUN, _card_rank(True), lambda v: _card(v, key))
    parts = _values_pass(parts, _NUMBERS, key)
    parts = _runs_pass(parts, _CARD_RUN, _card_rank(False), lambda v: _card(v, key))
    return F.when(text.rlike("[0-9@=:]") & text.rlike(PATTERN), F.array_join(parts, "")).otherwise(text)


def pseudonymize_documents(docs: DataFrame, key: str = KEY, text_col: str = "text") -> DataFrame:
    """All columns and rows of ``docs`` with ``text_col`` pseudonymised, row by row and without a shuffle.

    Null and empty texts stay as they are; repeated rows get equal results; an
    empty table gives none. A text is searched as a whole, in memory, whatever its
    length. The key is a literal of the plan, so it shows in ``explain`` and in event logs.
    """
    return docs.withColumn(text_col, pseudonymize(F.col(text_col), key))
