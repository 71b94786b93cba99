"""Format-preserving Feistel pseudonyms for personal data (operator 6), DataFrame functions only.

Each value that is found and validated is replaced by a keyed permutation of
the values of its own format: a card number by a card number that passes the
Luhn check, a date by a date in the same notation, an address by an address.
A permutation maps equal values to equal pseudonyms and different ones to
different ones, in every document, so links survive; whoever holds the key can
turn the rounds back.

Two networks do the work. Numbers are split in two factors and each round adds
a keyed hash of one factor to the other modulo its size. Strings are split in
two halves and each round adds keyed hashes to the letters and digits of one
half, each modulo the size of its class, so case, length and punctuation stay.

Cards are looked for in whole runs of numbers: every stretch of 13 to 19 digits
that begins and ends with a number is tested, so numbers beside a card do not
hide it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locastar.llm.common import fresh

ROUNDS = 8

OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
#: What names a secret that follows it.
NAME = r"(?i:password|passwd|pwd|secret|token|api[_-]?key)(?:=[\"']?| = ?[\"']|[\"']? ?[:=] ?[\"']?(?=[A-Za-z+/_-]*+\d))"
#: Letters and digits of any alphabet: parts of an address.
ANY = r"\p{L}\p{M}\p{N}"
#: National digits of a number -> country codes where all (or nearly all) numbers have that many.
NATIONAL = {8: "45|47|65|85[23]", 9: "27|3[134]|351|41|42[01]|48|61", 10: "[17]|44|52|57|63|9[01]", 11: "86"}
#: Between two digits of such a number.
GAP = r"(?:[ .-]|[ .-]?\(|\)[ .-]?)?"
#: A group of a number whose length is open; a card's groups are no part of it.
GROUP = r"(?!\d{4}[ -](?:\d{4}[ -]\d{4}[ -]\d{4}|\d{6}[ -]\d{5})(?![ -]?\d))\d{2,4}"
#: Kind -> pattern. Earlier kinds win where two begin at one place. Runs are
#: taken whole and start behind a boundary, so long texts cost linear time.
PATTERNS = {
    "email": rf"(?<![{ANY}._%+-])[{ANY}._%+-]++@(?=[{ANY}])[{ANY}.-]*\.\p{{L}}{{2,}}+(?![{ANY}])",
    "date": r"(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4})(?![./-]?\d)",
    "ip": rf"(?<![\d.]){OCTET}(?:\.{OCTET}){{3}}(?!\.?\d)",
    "phone": r"(?=\+)(?<![\w+])\+(?:" + "".join(rf"(?:{codes})(?: ?\(0\))?(?:{GAP}\d){{{n}}}(?!\d)|" for n, codes in NATIONAL.items())
             + rf"\d{{1,3}}(?:(?:-{GROUP}){{2,5}}|(?:\.{GROUP}){{2,5}})(?![.-]?\d)"
             rf"|\d{{1,3}}[ .-]?\(\d{{1,4}}\)[ .-]?\d{{2,4}}(?:[ .-]{GROUP}){{1,3}}(?!\d)"
             rf"|\d{{1,3}}(?:[ .-]{GROUP}){{2,5}}(?!\d)|\d{{8,15}}(?!\d))"
             r"|(?<![\w+-])\(\d{3}\) ?\d{3}-\d{4}(?![\d-])|(?<![\w+-])\d{3}-\d{3}-\d{4}(?![\d-])",
    "ssn": r"(?<![\w-])(?!000|666|9\d\d)\d{3}-(?!00)\d{2}-(?!0000)\d{4}(?![\w-])",
}
#: A run of numbers that may hold cards; a value of another kind ends it.
RUN = rf"(?<![\w.-])\d(?:(?:-| (?=\d)(?!{'|'.join(PATTERNS.values())}))?\d){{12,}}+"
SECRET = rf"(?<![A-Za-z0-9])(?:AKIA[A-Z0-9]{{16,}}+|gh[pousr]_[A-Za-z0-9]{{36,}}+|sk-[A-Za-z0-9]{{20,}}+)(?![A-Za-z0-9])|{NAME}(?!{PATTERNS['email']})[A-Za-z0-9+/_-]{{8,}}+"
PATTERNS = {"email": PATTERNS.pop("email"), "secret": SECRET, **PATTERNS, "card": RUN}
KINDS = tuple(PATTERNS)
#: A text without any of these holds no value of any kind.
HINT = r"[0-9@=]|AKIA|gh[pousr]_|sk-"

DIGITS, UPPER, LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Capitals and small letters beyond ASCII of Latin-1, Greek and Cyrillic; other letters stay as they are.
BEYOND = tuple("".join(chr(c) for c in range(a, a + n) if c not in (0xD7, 0xF7, 0x3A2))
               for a, n in ((0xC0, 31), (0xE0, 31), (0x391, 25), (0x3B1, 25), (0x410, 32), (0x430, 32)))


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), use)[0]


def draw(key: str, tweak: Column, round_: Column, seen: Column) -> Column:
    """60 bits keyed by the round, the format and the other half, as a long."""
    said = F.concat_ws("|", F.lit(key), tweak, round_.cast("string"), seen.cast("string"))
    return F.conv(F.substring(F.sha2(said, 256), 1, 15), 16, 10).cast("long")


def permuted_number(key: str, tweak: Column, value: Column, low: int, high: int) -> Column:
    """A keyed permutation of 0 .. low * high - 1 (low, high: the sizes of the two factors)."""
    start = F.struct((F.floor(value / F.lit(high)).cast("long")).alias("a"), F.pmod(value, F.lit(high)).cast("long").alias("b"))

    def turn(s: Column, r: Column) -> Column:
        even = r % 2 == 0
        a = F.when(even, F.pmod(s["a"] + F.pmod(draw(key, tweak, r, s["b"]), F.lit(low)), F.lit(low))).otherwise(s["a"])
        b = F.when(~even, F.pmod(s["b"] + F.pmod(draw(key, tweak, r, s["a"]), F.lit(high)), F.lit(high))).otherwise(s["b"])
        return F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))

    done = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)
    return done["a"] * F.lit(high) + done["b"]


def moved(char: Column, by: Column) -> Column:
    """A character moved inside its class: digits, capitals, small letters; others stay."""
    members = F.when(F.length(char) != 1, None)
    for these in (DIGITS, UPPER, LOWER, *BEYOND):
        members = members.when(F.instr(F.lit(these), char) > 0, F.lit(these))
    return F.coalesce(bound(members, lambda m: F.when(
        m.isNotNull(), F.substring(m, (F.pmod(F.instr(m, char) - 1 + by, F.length(m)) + 1).cast("int"), F.lit(1)))), char)


def permuted_string(key: str, tweak: Column, value: Column) -> Column:
    """A keyed permutation of the strings with this pattern of classes.

    Each round has two steps: the half that it hashes is noted, a long one by
    its digest, then the other half is moved, so time is linear in the length.
    """
    half = F.floor(F.length(value) / 2).cast("int")
    start = F.struct(F.substring(value, F.lit(1), half).alias("a"), F.substring(value, half + 1, F.length(value)).alias("b"), F.lit("").alias("seen"))

    def added(text: Column, seen: Column, r: Column) -> Column:
        return F.when(text == "", text).otherwise(F.array_join(F.transform(
            F.split(text, ""), lambda c, i: moved(c, F.pmod(draw(key, F.concat_ws("/", tweak, i.cast("string")), r, seen), F.lit(1_000_000)))), ""))

    def turn(s: Column, step: Column) -> Column:
        r = F.floor(step / 2).cast("int")
        even, move = r % 2 == 0, step % 2 == 1
        other = F.when(even, s["b"]).otherwise(s["a"])
        mine = F.when(even, s["a"]).otherwise(s["b"])
        note = F.struct(s["a"].alias("a"), s["b"].alias("b"), F.when(F.length(other) > 64, F.sha2(other, 256)).otherwise(other).alias("seen"))
        return F.when(~move, note).otherwise(bound(added(mine, s["seen"], r), lambda m: F.struct(
            F.when(even, m).otherwise(s["a"]).alias("a"), F.when(even, s["b"]).otherwise(m).alias("b"), F.lit("").alias("seen"))))

    done = F.aggregate(F.sequence(F.lit(0), F.lit(2 * ROUNDS - 1)), start, turn)
    return F.concat(done["a"], done["b"])


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, r"\D", "")


def refilled(value: Column, digits: Column) -> Column:
    """``value`` with its digits replaced in order by those of ``digits``."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))
    filled = F.aggregate(F.split(value, ""), start, lambda s, c: F.struct(
        F.concat(s["out"], F.when(c.rlike(r"^\d$"), F.substring(digits, s["at"], F.lit(1))).otherwise(c)).alias("out"),
        (s["at"] + F.when(c.rlike(r"^\d$"), 1).otherwise(0)).alias("at")))
    return filled["out"]


def luhn_sum(digits: Column, doubled_last: bool) -> Column:
    """Sum of the Luhn check from the right; ``doubled_last``: the last digit counts twice."""
    shift = 0 if doubled_last else 1
    weighed = F.transform(F.reverse(F.split(digits, "")), lambda c, i: F.when(
        (i + shift) % 2 == 0, F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)).otherwise(c.cast("int")))
    return F.aggregate(weighed, F.lit(0), lambda a, x: a + x)


def card(key: str, value: Column) -> Column:
    """All digits but the last are permuted; the last is the new check digit."""
    digits = digits_of(value)
    body = permuted_string(key, F.concat(F.lit("card"), F.length(digits).cast("string")), F.substring(digits, F.lit(1), F.length(digits) - 1))
    check = F.pmod(F.lit(10) - F.pmod(luhn_sum(body, True), F.lit(10)), F.lit(10))
    return F.when(luhn_sum(digits, False) % 10 == 0, refilled(value, F.concat(body, check.cast("string")))).otherwise(value)


#: Usual groups of a card, with one separator.
GROUPED = (r"^(?:\d{4}([ -])\d{4}\1\d{4}\1\d{4}(?:\1\d{3})?|\d{4}([ -])\d{6}\2\d{4,5}|\d{4}([ -])\d{4}\3\d{5}"
           r"|\d{4}([ -])\d{3}\4\d{3}\4\d{3}|\d{6}[ -]\d{13}|\d{8}[ -]\d{8})$")
#: Numbers of the large issuers, by first digits and length.
ISSUED = r"^(?:4\d{12}(?:\d{3}){0,2}|3[47]\d{13}|3[0689]\d{12}|(?:35|2[2-7])\d{14}|5\d{15}|6\d{15,18})$"


def piece(kind: Column, value: Column, new: Column) -> Column:
    return F.struct(kind.cast("string").alias("kind"), value.alias("value"), new.alias("pseudonym"))


def plain(value: Column) -> Column:
    return piece(F.lit(None), value, value)


def card_pieces(key: str, run: Column) -> Column:
    """A run of numbers as pieces: its cards, and what lies between them with a null kind.

    Where stretches with a valid check digit overlap, a number without blanks
    goes first, then usual groups of a large issuer, other usual groups, the
    whole run, and other groups of a large issuer; then the earlier one.
    """

    def pieces(t: Column) -> Column:  # numbers and separators by turns
        # a slice copies the whole array, so items are named one by one
        def items(start: Column, end: Column) -> Column:
            return F.transform(F.sequence(start, end - 1), lambda k: t[k])

        def best(at: Column) -> Column:
            return bound(items(at - 1, F.least(at + 36, F.size(t))), lambda w: best_of(at, w))

        def best_of(at: Column, w: Column) -> Column:
            ends = F.sequence(F.lit(1), F.size(w), F.lit(2))
            cuts = F.transform(ends, lambda n: F.struct(n.alias("n"), F.array_join(F.slice(w, 1, n), "").alias("shown")))
            cuts = F.transform(cuts, lambda c: F.struct(c["n"].alias("n"), c["shown"].alias("shown"), F.translate(c["shown"], " -", "").alias("digits")))
            cuts = F.filter(cuts, lambda c: F.length(c["digits"]).between(13, 19) & (luhn_sum(c["digits"], False) % 10 == 0))
            issued = lambda c: c["digits"].rlike(ISSUED)
            grouped = lambda c: c["shown"].rlike(GROUPED)
            ranked = F.transform(cuts, lambda c: F.struct(
                F.when(c["n"] == 1, 0).when(grouped(c) & issued(c), 1).when(grouped(c), 2)
                .when(c["n"] == F.size(t), 3).when(issued(c), 4).alias("rank"), c["n"].alias("n")))
            return F.array_min(F.filter(ranked, lambda c: c["rank"].isNotNull()))

        def choose(found: Column) -> Column:
            def taken(s: Column, c: Column) -> Column:
                better = (c["n"] > 1) & F.exists(F.sequence(F.lit(1), F.floor(c["n"] / 2).cast("int")), lambda j: F.coalesce(found[c["k"] + j]["rank"] < c["rank"], F.lit(False)))
                end = c["k"] * 2 + c["n"]
                return F.when(c["rank"].isNull() | (c["k"] * 2 < s["past"]), s).when(better, s).otherwise(F.struct(
                    end.alias("past"), F.concat(s["at"], F.array(F.struct(s["past"].alias("after"), (c["k"] * 2).alias("start"), end.alias("end")))).alias("at")))

            start = F.struct(F.lit(0).alias("past"), F.expr("cast(array() as array<struct<after:int,start:int,end:int>>)").alias("at"))
            numbered = F.transform(found, lambda c, k: F.struct(c["rank"].alias("rank"), c["n"].alias("n"), k.alias("k")))
            return F.aggregate(numbered, start, taken)

        def cut(s: Column) -> Column:
            shown = lambda a, b: F.when(a < b, F.array_join(items(a, b), "")).otherwise("")
            cards = F.transform(s["at"], lambda c: F.array(plain(shown(c["after"], c["start"])), bound(
                shown(c["start"], c["end"]), lambda v: piece(F.lit("card"), v, card(key, v)))))
            return F.concat(F.flatten(cards), F.array(plain(shown(s["past"], F.size(t)))))

        found = F.transform(F.sequence(F.lit(1), F.size(t), F.lit(2)), best)
        return bound(bound(found, choose), cut)

    return F.when(run.rlike(r"^\d{20,}+$"), F.array(plain(run))).otherwise(bound(F.regexp_extract_all(run, F.lit(r"\d+|[ -]"), F.lit(0)), pieces))


#: Days in 400 years, the calendar's period, as two factors.
PERIOD = (189, 773)
#: First day of the period that holds most dates.
EPOCH = "1800-01-01"


def day_read(value: Column) -> Column:
    """struct(day, us): the date that ``value`` writes, null if none, and if it is read month first."""
    parts = F.split(value, r"[-./]")
    number = lambda k: F.element_at(parts, k).cast("int")
    made = lambda y, m, d: F.try_to_date(F.format_string("%04d-%02d-%02d", y, m, d), "yyyy-MM-dd")
    day_first = made(number(3), number(2), number(1))
    us = (F.instr(value, "/") > 0) & day_first.isNull()
    day = F.when(F.instr(value, "-") > 0, made(number(1), number(2), number(3))).when(us, made(number(3), number(1), number(2))).otherwise(day_first)
    return F.struct(day.alias("day"), us.alias("us"))


def date(key: str, value: Column) -> Column:
    """A date of the same 400 years in the same notation; what is no date stays.

    Dates with slashes are read day first, or month first where only that is
    a date; the pseudonym keeps the order read, which its form may not show.
    """
    slashed, dashed = F.instr(value, "/") > 0, F.instr(value, "-") > 0
    size = PERIOD[0] * PERIOD[1]

    def moved_day(day: Column) -> Column:
        return bound(F.date_diff(day, F.lit(EPOCH).cast("date")).cast("long"), lambda past: F.date_add(F.lit(EPOCH).cast("date"), (
            F.floor(past / F.lit(size)).cast("long") * size + permuted_number(
                key, F.concat(F.lit("date"), F.floor(past / F.lit(size)).cast("string")), F.pmod(past, F.lit(size)), *PERIOD)).cast("int")))

    def shown(new: Column, us: Column) -> Column:
        parts = F.split(value, r"[-./]")
        wide = lambda k, n: F.when(F.length(F.element_at(parts, k)) == 2, F.lpad(n.cast("string"), 2, "0")).otherwise(n.cast("string"))
        first, second = F.when(us, F.month(new)).otherwise(F.dayofmonth(new)), F.when(us, F.dayofmonth(new)).otherwise(F.month(new))
        sign = F.when(slashed, "/").otherwise(".")
        return F.when(dashed, F.date_format(new, "yyyy-MM-dd")).otherwise(
            F.concat(wide(1, first), sign, wide(2, second), sign, F.lpad(F.year(new).cast("string"), 4, "0")))

    return bound(day_read(value), lambda read: F.when(read["day"].isNull() | (F.year(read["day"]) < 1), value).otherwise(
        bound(moved_day(read["day"]), lambda new: shown(new, read["us"]))))


def ip(key: str, value: Column) -> Column:
    octets = F.transform(F.split(value, r"\."), lambda o: o.cast("long"))
    number = F.aggregate(octets, F.lit(0).cast("long"), lambda a, o: a * 256 + o)
    new = permuted_number(key, F.lit("ip"), number, 1 << 16, 1 << 16)
    return F.concat_ws(".", *[F.pmod(F.shiftright(new, up), F.lit(256)).cast("string") for up in (24, 16, 8, 0)])


def phone(key: str, value: Column) -> Column:
    """The country code stays, the other digits are permuted."""
    kept = F.regexp_extract(value, r"^\+(?:\d{1,3}(?=[ .(-])|\d)", 0)
    rest = F.substring(value, F.length(kept) + 1, F.length(value))
    digits = digits_of(rest)
    return F.concat(kept, refilled(rest, permuted_string(key, F.concat(F.lit("phone"), kept), digits)))


def ssn(key: str, value: Column) -> Column:
    """Area 001-899 without 666 (898 values), group 01-99, serial 0001-9999."""
    area, group, serial = (F.element_at(F.split(value, "-"), k).cast("long") for k in (1, 2, 3))
    a = area - 1 - F.when(area > 666, 1).otherwise(0)
    new = permuted_number(key, F.lit("ssn"), (a * 99 + group - 1) * 9999 + serial - 1, 898 * 99, 9999)
    b = F.floor(new / F.lit(99 * 9999)).cast("long")
    return F.format_string("%03d-%02d-%04d", b + 1 + F.when(b >= 665, 1).otherwise(0),
                           F.pmod(F.floor(new / F.lit(9999)).cast("long"), F.lit(99)) + 1, F.pmod(new, F.lit(9999)) + 1)


def email(key: str, value: Column) -> Column:
    """Local part and first label of the domain are permuted, each by itself; the rest stays."""
    local, domain = F.split(value, "@")[0], F.split(value, "@")[1]
    label = F.regexp_extract(domain, r"^[^.]+", 0)
    return F.concat(permuted_string(key, F.lit("local"), local), F.lit("@"), permuted_string(key, F.lit("label"), label),
                    F.substring(domain, F.length(label) + 1, F.length(domain)))


def secret(key: str, value: Column) -> Column:
    kept = F.regexp_extract(value, r"^(?:AKIA|gh[pousr]_|sk-)?", 0)
    return bound(kept, lambda lead: F.concat(lead, permuted_string(
        key, F.concat(F.lit("secret"), lead), F.substring(value, F.length(lead) + 1, F.length(value)))))


PSEUDONYMS = {"email": email, "secret": secret, "date": date, "ip": ip, "phone": phone, "ssn": ssn, "card": card}


def pseudonymise(docs: DataFrame, key: str = "change me", kinds: tuple[str, ...] = KINDS, text: str = "text",
                 out: str = "pii") -> DataFrame:
    """``docs`` with the values in ``text`` replaced, and ``out``: array of struct(kind, value, pseudonym).

    All rows and other columns stay as they are; a null text stays null and an
    empty one empty, with no values. Equal values get equal pseudonyms in all
    rows for one ``key``, which must be kept secret.
    """
    some = "|".join(PATTERNS[k] for k in kinds)

    def kind_of(value: Column, named: Column) -> Column:
        # the patterns' boundaries hold at the ends of a value too; a run of
        # numbers is told by its digits, and what follows the name of a secret
        # is of another kind only if it is valid there
        out = F.lit("secret" if "secret" in kinds else kinds[-1])
        if "card" in kinds:
            run = value.rlike(r"^\d(?:[ -]?\d){12,}+$")
            out = F.when(run & (~named | (value.rlike(r"^\d(?:-?\d){12,18}$") & (luhn_sum(digits_of(value), False) % 10 == 0))), F.lit("card")).otherwise(out)
        for k in reversed([k for k in kinds if k not in ("secret", "card")]):
            valid = value.rlike(rf"^(?:{PATTERNS[k]})$")
            out = F.when(valid & (~named | day_read(value)["day"].isNotNull()) if k == "date" else valid, F.lit(k)).otherwise(out)
        return out

    def pieces_of(v: Column) -> Column:
        new = v["value"]
        for k in kinds:
            new = F.when(v["kind"] == k, PSEUDONYMS[k](key, v["value"])).otherwise(new)
        one = F.array(plain(v["lead"]), piece(v["kind"], v["value"], new))
        return F.when((v["kind"] == "card") & (v["lead"] == ""), card_pieces(key, v["value"])).otherwise(one) if "card" in kinds else one

    def split(m: Column) -> Column:
        lead = F.regexp_extract(m, f"^{NAME}", 0)
        return F.struct(lead.alias("lead"), F.substring(m, F.length(lead) + 1, F.length(m)).alias("value"))

    none = F.expr("cast(array() as array<struct<kind:string,value:string,pseudonym:string>>)")
    held, cut = fresh(docs, "found"), fresh(docs, "pieces")
    matches = F.transform(F.regexp_extract_all(F.col(text), F.lit(some), F.lit(0)), split)
    found = docs.withColumn(held, F.when(F.col(text).rlike(HINT), F.transform(
        matches, lambda v: F.struct(v["lead"].alias("lead"), kind_of(v["value"], v["lead"] != "").alias("kind"), v["value"].alias("value")))))
    found = found.withColumn(cut, F.when(F.size(held) > 0, F.transform(held, pieces_of)))
    between = F.split(F.col(text), some, -1)
    changed = F.when(F.size(cut) > 0, F.concat(F.array_join(F.zip_with(
        F.slice(between, 1, F.size(cut)), cut, lambda t, p: F.concat(t, F.array_join(F.transform(p, lambda x: x["pseudonym"]), ""))), ""),
        F.element_at(between, -1))).otherwise(F.col(text))
    values = F.when(F.size(cut) > 0, F.filter(F.flatten(cut), lambda x: x["kind"].isNotNull())).otherwise(none)
    return found.withColumns({text: changed, out: values}).drop(held, cut)


def summary(done: DataFrame) -> DataFrame:
    """Per row: doc_id, the new text, how many values of each kind changed, and their pseudonyms in order."""
    changed = F.filter("pii", lambda v: v["value"] != v["pseudonym"])
    counts = [F.size(F.filter(changed, (lambda k: lambda v: v["kind"] == k)(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return done.select("doc_id", "text", *counts, F.array_join(F.transform(changed, lambda v: F.concat_ws("=", v["kind"], v["pseudonym"])), ";").alias("pseudonyms"))
