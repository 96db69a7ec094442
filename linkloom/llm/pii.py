"""PII surrogates: keyed, type-consistent replacements of personal data, with DataFrame expressions alone.

Entities are e-mail addresses, telephone numbers, payment cards (by their check digit), IPv4 and IPv6 addresses, US social
security numbers, IBANs (by their check digits), credentials, and personal names (after a form of address or with a
known given name).  A surrogate is drawn from HMAC-SHA-256 of the units that make up an entity, so the same entity has the
same surrogate in every document.  Units: an e-mail has its address and its host, a name its parts, every other entity is
one unit in its normal form (without layout).  So "Mr Smith" and "John Smith" agree, and addresses of one host stay together.
A surrogate keeps the format: digits stay digits, letters stay letters of the same case and script, marks stay; cards
and IBANs get right check digits, IPv4 addresses stay in range, and given names are exchanged for given names of the same
gender and script by a keyed permutation of their list.

The key comes from the argument, the setting `KEY_SETTING` or the variable `KEY_VARIABLE`; without one it is random, and the
same only within one application.  It reaches the expressions through a scalar subquery on a local relation, so no plan,
explain output or event log shows it (Spark also redacts settings whose name holds "secret").

Collision checks: over the distinct units of the whole table, a surrogate that two units share, or that is itself a unit
of the table, is drawn again for all but the smallest of them, until none is left; from draw `WIDEN` on, hosts, local
parts, name parts and telephone numbers grow by a character a draw, so that short forms can't run out.  Where the format
is fixed and `ROUNDS` draws don't reach distinctness, an error is raised.  A redraw of one name part leaves the others.
Given names, being permuted, are distinct by themselves, and may be other given names of the table.  Only texts
that hold a redrawn unit take another draw than the first, and are found by a join on the text's digest.

Defined results: a null text stays null with no entities; overlapping candidates are taken leftmost, in the order of
`PATTERNS`; digit groups without a valid check digit, dotted numbers out of range and names without a cue are left
alone; an e-mail's local part has 128 characters at most, its host 127 labels; repeated rows are treated alike; a
document's other columns are carried through, but ``pii_types`` and ``n_pii`` replace columns of these names.
"""

from __future__ import annotations

import hashlib
import hmac
import os
import secrets

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import Workspace

#: Forms of address, and given names by script and gender.
TITLES = {"m": ("Mr", "Herr", "Monsieur", "Señor", "Sr", "господин"), "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "госпожа"), "x": ("Dr", "Prof")}
GIVEN = {
    ("latin", "m"): ("James", "John", "Robert", "Michael", "William", "David", "Thomas", "Peter", "Hans", "Klaus", "Jürgen", "Pierre", "Jean", "Luc", "Carlos", "José", "Miguel", "Pablo"),
    ("latin", "f"): ("Mary", "Linda", "Susan", "Karen", "Emma", "Alice", "Helen", "Anna", "Greta", "Ursula", "Sabine", "Claire", "Amélie", "Sophie", "Carmen", "Lucía", "Isabel", "Elena"),
    ("cyrillic", "m"): ("Иван", "Пётр", "Алексей", "Дмитрий", "Сергей", "Николай"),
    ("cyrillic", "f"): ("Анна", "Мария", "Елена", "Ольга", "Наталья", "Татьяна"),
}
#: Lower-case letters that a replaced letter is drawn from.
LETTERS = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзиклмнопрстуфхцчшэюя", "greek": "αβγδεζηθικλμνξοπρστυφχψω"}

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_HEX = "[0-9A-Fa-f]{1,4}"
_NAME = r"\p{Lu}[\p{Ll}\-']+"
_TITLE = "(?:" + "|".join(t for group in TITLES.values() for t in group) + r")\.?"
_GIVEN = "(?:" + "|".join(n for group in GIVEN.values() for n in group) + ")"
#: Type and pattern, in the order in which they are tried at one place; all begin where no letter or digit stands before.
#: Every repetition of a group is bounded: Java's matcher recurses into those, and the work at one place stays bounded.
NUMBERS = {
    "ssn": r"(?<!-)\d{3}-\d{2}-\d{4}(?![\d\-])",
    "phone": r"(?<!\+)(?:\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)[ .\-]?)?\d{2,4}(?:[ .\-]?\d{2,4}){1,4}|\(\d{3}\) ?\d{3}[\-. ]\d{4}|\d{3}[\-.]\d{3}[\-.]\d{4})(?![\p{L}\p{N}])",
    "card": r"\d(?:[ \-]?\d){12,18}(?![\p{L}\p{N}])",
    "ip": rf"(?<!\.){_OCTET}(?:\.{_OCTET}){{3}}(?![\p{{L}}\p{{N}}]|\.\d)",
}
OTHERS = {
    "email": r"[\p{L}\p{N}][\p{L}\p{N}._%+\-]{0,127}+@(?:[\p{L}\p{N}\-]{1,63}\.){1,126}\p{L}{2,63}",
    "secret": r"(?:[0-9A-Fa-f]{64}|[0-9A-Fa-f]{40}|[0-9A-Fa-f]{32}|AKIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36}|sk-[0-9A-Za-z]{20,})(?![\p{L}\p{N}])",
    "iban": r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "name": rf"(?=\p{{Lu}}|госп)(?:{_TITLE} (?:{_NAME} )?{_NAME}|{_GIVEN} {_NAME})(?![\p{{L}}\p{{N}}])",
    "ip6": rf"(?<!:)(?:(?:{_HEX}:){{7}}{_HEX}|(?:{_HEX}:){{2,6}}(?::{_HEX}){{1,5}})(?![\p{{L}}\p{{N}}:])",
}
PATTERNS = OTHERS | NUMBERS
ANY = r"(?<![\p{L}\p{N}])(?:(?=[\p{L}\p{N}])(?:" + "|".join(OTHERS.values()) + r")|(?=[\d+(])(?:" + "|".join(NUMBERS.values()) + "))"
#: Put around matches; a text that holds it is cut by the pattern itself.
MARK = "\u0001\u0002\u0001"
KEY_SETTING, KEY_VARIABLE = "spark.linkloom.pii.secret", "LINKLOOM_PII_SECRET"
#: What stays of a telephone number (the country code) and of a credential (its kind).
PHONE_LEAD, SECRET_LEAD = r"^\+\d{1,3}(?=[ .\-(])", "^(AKIA|gh._|sk-)"
#: The draw from which units of a free length grow, and the draws after which one of a fixed length is given up.
WIDEN, ROUNDS = 4, 60

_made: dict[str, bytes] = {}


def _q(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def secret_key(spark: SparkSession, key: str | bytes | None = None) -> bytes:
    key = key or spark.conf.get(KEY_SETTING, None) or os.environ.get(KEY_VARIABLE)
    if key:
        return key.encode() if isinstance(key, str) else bytes(key)
    return _made.setdefault(spark.sparkContext.applicationId, secrets.token_bytes(32))


def given_names(key: bytes) -> dict[str, str]:
    """Each given name's surrogate: the next one in its list, in an order drawn by the key."""
    out = {}
    for (script, gender), names in GIVEN.items():
        order = sorted(names, key=lambda n: hmac.digest(key, f"given|{script}|{gender}|{n}".encode(), "sha256"))
        out |= dict(zip(order, order[1:] + order[:1]))
    return out


def _key_column(spark: SparkSession, key: bytes) -> Column:
    """struct(i, o: the two key blocks of HMAC, given: the map of given names), from a relation of one row in the JVM."""
    block = (hashlib.sha256(key).digest() if len(key) > 64 else key).ljust(64, b"\0")
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    names = jvm.java.util.ArrayList()
    for pair in given_names(key).items():
        names.add("=".join(pair))
    cells = gateway.new_array(jvm.java.lang.Object, 3)
    cells[0], cells[1], cells[2] = bytearray(b ^ 0x36 for b in block), bytearray(b ^ 0x5C for b in block), names
    rows = jvm.java.util.ArrayList()
    rows.add(jvm.org.apache.spark.sql.RowFactory.create(cells))
    schema = jvm.org.apache.spark.sql.types.StructType.fromDDL("i binary, o binary, g array<string>")
    made = DataFrame(spark._jsparkSession.createDataFrame(rows, schema), spark)
    given = F.map_from_entries(F.transform("g", lambda x: F.struct(F.substring_index(x, "=", 1), F.substring_index(x, "=", -1))))
    return made.select(F.struct("i", "o", given.alias("given"))).scalar()


def _hmac(message: str) -> str:
    """HMAC-SHA-256 in hexadecimal digits; the key is the column kk."""
    return f"sha2(concat(kk.o, unhex(sha2(concat(kk.i, CAST({message} AS BINARY)), 256))), 256)"


def _byte(stream: str, i: str) -> str:
    return f"CAST(conv(substring({stream}, 2 * ((({i}) - 1) % 64) + 1, 2), 16, 10) AS INT)"


def _drawn(e: str, stream: str, digits_only: bool = False, hexadecimal: str = "false") -> str:
    """e with every digit and letter drawn anew from the same class, script and case."""
    b, c = _byte(stream, "i"), f"substring({e}, i, 1)"
    letters = ""
    if not digits_only:
        for script, (lo, hi) in {"latin": ("a", "z"), "cyrillic": ("а", "я"), "greek": ("α", "ω")}.items():
            table = _q(LETTERS[script])
            new = f"substring({table}, 1 + {b} % {len(LETTERS[script])}, 1)"
            if script == "latin":
                new = f"CASE WHEN {hexadecimal} THEN substring('abcdef', 1 + {b} % 6, 1) ELSE {new} END"
            letters += f" WHEN {c} >= '{lo}' AND {c} <= '{hi}' THEN {new} WHEN {c} >= '{lo.upper()}' AND {c} <= '{hi.upper()}' THEN upper({new})"
        other = f"substring({_q(LETTERS['latin'])}, 1 + {b} % 26, 1)"
        letters += f" WHEN {c} RLIKE {_q(chr(92) + 'p{Ll}')} THEN {other} WHEN {c} RLIKE {_q(chr(92) + 'p{Lu}')} THEN upper({other})"
    one = f"CASE WHEN {c} >= '0' AND {c} <= '9' THEN CAST({b} % 10 AS STRING){letters} ELSE {c} END"
    return f"CASE WHEN length({e}) > 0 THEN array_join(transform(sequence(1, length({e})), i -> {one}), '') ELSE '' END"


def _luhn(digits: str) -> str:
    """The Luhn sum of a string of digits, the last one being the check digit."""
    d = f"CAST(substring(reverse({digits}), i, 1) AS INT)"
    return f"aggregate(sequence(1, length({digits})), 0, (acc, i) -> acc + CASE WHEN i % 2 = 1 THEN {d} WHEN {d} > 4 THEN 2 * {d} - 9 ELSE 2 * {d} END)"


def _mod97(compact: str) -> str:
    """An IBAN without spaces, first four characters last and letters as numbers, modulo 97."""
    turned = f"concat(substring({compact}, 5), substring({compact}, 1, 4))"
    c = f"substring({turned}, i, 1)"
    number = f"CASE WHEN {c} >= 'A' THEN ascii({c}) - 55 ELSE CAST({c} AS INT) END"
    return f"aggregate(sequence(1, length({compact})), 0, (acc, i) -> CASE WHEN {c} >= 'A' THEN (acc * 100 + {number}) % 97 ELSE (acc * 10 + {number}) % 97 END)"


def entity_type(e: str) -> str:
    """The type of a match of ANY, as a SQL expression; null for what fails its check."""
    whens = []
    for kind, pattern in PATTERNS.items():
        test = f"{e} RLIKE {_q('^(?:' + pattern + ')$')}"
        if kind == "card":
            whens.append(f"WHEN {test} THEN CASE WHEN {_luhn(f'regexp_replace({e}, {_q('[^0-9]')}, {_q('')})')} % 10 = 0 THEN 'card' END")
        elif kind == "iban":
            whens.append(f"WHEN {test} THEN CASE WHEN {_mod97(f'replace({e}, {_q(' ')}, {_q('')})')} = 1 THEN 'iban' END")
        else:
            whens.append(f"WHEN {test} THEN '{kind}'")
    return f"CASE {' '.join(whens)} END"


_TITLE_LIST = "array(" + ", ".join(_q(t) for group in TITLES.values() for t in group) + ")"
_GIVEN_LIST = "array(" + ", ".join(_q(n) for group in GIVEN.values() for n in group) + ")"
_DIGITS = "regexp_replace(x.e, '[^0-9]', '')"
_LEAD = f"regexp_extract(x.e, {_q(PHONE_LEAD)}, 0)"
#: The units of a mention x (kind, e), each a struct (kind, n: its normal form); a telephone number's lead stands before a space.
UNITS = f"""CASE x.kind
WHEN 'email' THEN array(named_struct('kind', 'local', 'n', lower(x.e)), named_struct('kind', 'host', 'n', lower(substring_index(x.e, '@', -1))))
WHEN 'name' THEN transform(split(x.e, ' '), p -> named_struct('kind', CASE WHEN array_contains({_TITLE_LIST}, replace(p, '.', '')) THEN 'title' WHEN array_contains({_GIVEN_LIST}, p) THEN 'given' ELSE 'part' END, 'n', p))
WHEN 'phone' THEN array(named_struct('kind', x.kind, 'n', concat({_LEAD}, ' ', regexp_replace(substring(x.e, length({_LEAD}) + 1), '[^0-9+]', ''))))
ELSE array(named_struct('kind', x.kind, 'n', CASE x.kind WHEN 'ip6' THEN lower(x.e) WHEN 'iban' THEN replace(x.e, ' ', '') WHEN 'ip' THEN x.e WHEN 'secret' THEN x.e ELSE {_DIGITS} END)) END"""


def surrogates(units: str, attempt: str) -> str:
    """The surrogates, in normal form, of an array of units, a SQL expression; `attempt` is the draw, an expression over u.

    Built in steps, each of which names what the next one uses more than once.
    """
    message = lambda part: _hmac(f"concat(u.kind, '|{part}|', u.n, '|', CAST({attempt} AS STRING))")
    drawn = f"transform({units}, u -> named_struct('kind', u.kind, 'n', u.n, 'wide', greatest(0, least({attempt} - {WIDEN - 1}, 24)), 's', CASE WHEN u.kind IN ('title', 'given') THEN '' ELSE concat({message(0)}, {message(1)}) END))"
    # what is drawn before check digits: cards keep the first digit, IBANs the country
    card = f"concat(substring(u.n, 1, 1), {_drawn('substring(u.n, 2, length(u.n) - 2)', 'u.s', True)})"
    iban = f"concat(substring(u.n, 1, 2), '00', {_drawn('substring(u.n, 5)', 'u.s')})"
    # what is drawn of the others, with what they grow by
    more = "repeat(lower(substring(u.n, 1, 1)), u.wide)"
    top = "substring_index(u.n, '.', -1)"
    rest = f"""CASE u.kind WHEN 'local' THEN concat(substring_index(u.n, '@', 1), {more}) WHEN 'host' THEN concat({more}, substring(u.n, 1, length(u.n) - length({top})))
      WHEN 'part' THEN concat(u.n, {more}) WHEN 'phone' THEN concat(substring_index(u.n, ' ', -1), repeat('0', u.wide)) WHEN 'secret' THEN substring(u.n, length(regexp_extract(u.n, {_q(SECRET_LEAD)}, 0)) + 1) ELSE u.n END"""
    parted = f"transform({drawn}, u -> named_struct('kind', u.kind, 'n', u.n, 's', u.s, 'rest', {rest}, 'f', CASE u.kind WHEN 'card' THEN {card} WHEN 'iban' THEN {iban} END))"
    card = f"concat(u.f, CAST((10 - {_luhn('concat(u.f, ' + _q('0') + ')')} % 10) % 10 AS STRING))"
    iban = f"concat(substring(u.f, 1, 2), lpad(CAST(98 - {_mod97('u.f')} AS STRING), 2, '0'), substring(u.f, 5))"
    ip = f"concat_ws('.', CAST(1 + {_byte('u.s', '1')} % 223 AS STRING), CAST({_byte('u.s', '2')} AS STRING), CAST({_byte('u.s', '3')} AS STRING), CAST({_byte('u.s', '4')} AS STRING))"
    plain = _drawn("u.rest", "u.s", hexadecimal=f"(u.kind = 'ip6' OR (u.kind = 'secret' AND u.n RLIKE {_q('^[0-9A-Fa-f]+$')}))")
    return f"""transform({parted}, u -> CASE u.kind WHEN 'title' THEN u.n WHEN 'given' THEN coalesce(kk.given[u.n], u.n) WHEN 'card' THEN {card} WHEN 'iban' THEN {iban} WHEN 'ip' THEN {ip}
      ELSE concat(CASE u.kind WHEN 'phone' THEN concat(substring_index(u.n, ' ', 1), ' ') WHEN 'secret' THEN regexp_extract(u.n, {_q(SECRET_LEAD)}, 0) ELSE '' END, {plain},
                  CASE u.kind WHEN 'local' THEN concat('@', substring_index(u.n, '@', -1)) WHEN 'host' THEN {top} ELSE '' END) END)"""


def replacements(found: str, attempt: str) -> str:
    """What replaces each of an array of mentions x (kind, e): the surrogates of its units in its own layout and case."""
    made = f"transform({found}, x -> named_struct('kind', x.kind, 'e', x.e, 's', CASE WHEN x.kind IS NOT NULL THEN {surrogates(UNITS, attempt)} END))"
    # s: the surrogate's characters that fill the layout, from place `from` of the mention on
    filled = f"CASE x.kind WHEN 'email' THEN concat(substring_index(x.s[0], '@', 1), '@', x.s[1]) WHEN 'name' THEN array_join(x.s, ' ') WHEN 'phone' THEN substring_index(x.s[0], ' ', -1) ELSE x.s[0] END"
    made = f"transform({made}, x -> named_struct('kind', x.kind, 'e', x.e, 'lead', CASE WHEN x.kind = 'phone' THEN {_LEAD} ELSE '' END, 's', {filled}))"
    held = "substring(x.e, length(x.lead) + 1)"
    place = f"length(regexp_replace(substring({held}, 1, i), '[^0-9A-Z+]', ''))"
    layout = f"concat(x.lead, array_join(transform(sequence(1, length({held})), i -> CASE WHEN substring({held}, i, 1) RLIKE '[0-9A-Z+]' THEN substring(x.s, {place}, 1) ELSE substring({held}, i, 1) END), ''), substring(x.s, length(regexp_replace({held}, '[^0-9A-Z+]', '')) + 1))"
    cased = "CASE WHEN x.e = lower(x.e) THEN x.s ELSE array_join(transform(sequence(1, length(x.s)), i -> CASE WHEN substring(x.e, i, 1) <> lower(substring(x.e, i, 1)) THEN upper(substring(x.s, i, 1)) ELSE substring(x.s, i, 1) END), '') END"
    return f"transform({made}, x -> CASE WHEN x.kind IS NULL THEN x.e WHEN x.kind IN ('card', 'iban', 'ssn', 'phone') THEN {layout} WHEN x.kind IN ('email', 'ip6') THEN {cased} ELSE x.s END)"


def pieces(text: Column) -> Column:
    """A text cut at the matches of ANY: between, match, between, match, ..., between."""
    marked = F.split(F.regexp_replace(text, F.lit(f"({ANY})"), F.lit(f"{MARK}$1{MARK}")), MARK, -1)
    between, found = F.split(text, ANY, -1), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))
    slow = F.slice(F.flatten(F.transform(F.arrays_zip(between.alias("b"), found.alias("m")), lambda x: F.array(x["b"], F.coalesce(x["m"], F.lit(""))))), 1, 2 * F.size(between) - 1)
    return F.when(text.contains(MARK), slow).otherwise(marked)


def matches(cut: Column) -> Column:
    return F.filter(cut, lambda x, i: i % 2 == 1)


def redrawn(units: DataFrame, key: Column, space: Workspace, rounds: int = ROUNDS) -> DataFrame | None:
    """units (kind, n), distinct -> those whose surrogate had to be drawn again: kind, n, attempt; None if there are none.

    After the first draw of all only those that clash are drawn and compared again, with each other and with all that stay.
    """
    one = F.element_at(F.expr(surrogates("array(named_struct('kind', kind, 'n', n))", "attempt")), 1)
    draw = lambda rows, step: rows.select("kind", "n", F.lit(step).alias("attempt"), key.alias("kk")).select("kind", "n", "attempt", one.alias("s"))
    real = units.select("kind", F.col("n").alias("s"))

    def clashing(now: DataFrame, *taken: DataFrame) -> DataFrame:
        """(kind, n) of the rows of `now` whose surrogate a smaller unit of `now` shares, or that is in one of `taken`."""
        first = now.groupBy("kind", "s").agg(F.min("n").alias("first"))
        bad = now.join(first, ["kind", "s"]).where("n <> first").select("kind", "n")
        for other in taken:
            bad = bad.union(now.join(other.select("kind", "s"), ["kind", "s"], "left_semi").select("kind", "n"))
        return bad.distinct()

    now = space.save(draw(units, 0), "draw0")
    bad = space.save(clashing(now, real), "bad0")
    if not bad.limit(1).count():
        return None
    stays = space.save(now.join(bad, ["kind", "n"], "left_anti"), "stays")
    taken, accepted = [real, stays], []
    for step in range(1, rounds + 1):
        now = space.save(draw(bad, step), f"draw{step}")
        bad = space.save(clashing(now, *taken, *accepted), f"bad{step}")
        accepted.append(space.save(now.join(bad, ["kind", "n"], "left_anti"), f"accepted{step}"))
        left = bad.groupBy("kind").count().collect()
        if not left:
            out = accepted[0]
            for more in accepted[1:]:
                out = out.union(more)
            return out.select("kind", "n", "attempt")
    raise ValueError(f"no distinct surrogates after {rounds} draws: " + ", ".join(f"{r['count']} of kind {r['kind']}" for r in left))


def pseudonymise(docs: DataFrame, key: str | bytes | None = None) -> DataFrame:
    """docs with `text` replaced, and two more columns: ``pii_types`` (the type of each replaced entity, in order) and ``n_pii``."""
    spark = docs.sparkSession
    space, keyed = Workspace(spark, "pii"), _key_column(spark, secret_key(spark, key))
    typed = F.expr(f"transform(m, e -> named_struct('kind', {entity_type('e')}, 'e', e))")
    found = docs.withColumn("text", F.col("text").cast("string")).select(F.struct("*").alias("row")).withColumn("cut", pieces(F.col("row.text"))).withColumn("m", matches(F.col("cut")))
    units = found.where(F.size("m") > 0).select(F.explode(typed).alias("x")).where("x.kind IS NOT NULL").select(F.explode(F.expr(UNITS)).alias("u")).select("u.*")
    units = units.where("kind NOT IN ('title', 'given')").groupBy("kind", "n").agg(F.lit(1).alias("one")).select("kind", "n")
    again = redrawn(space.save(units, "units"), keyed, space)
    state = found.withColumn("m", typed)
    attempt = "0"
    if again is not None:  # only texts that hold one of the redrawn units are looked up, by the text's digest
        state = state.withColumn("d", F.struct(F.xxhash64("row.text"), F.crc32("row.text"), F.length("row.text")))
        held = state.where(F.size("m") > 0).select("d", F.explode("m").alias("x")).where("x.kind IS NOT NULL").select("d", F.explode(F.expr(UNITS)).alias("u")).select("d", "u.kind", "u.n").distinct()
        entry = F.struct(F.concat_ws("|", "kind", "n").alias("k"), "attempt")
        draws = space.save(held.join(space.save(again, "again"), ["kind", "n"]).groupBy("d").agg(F.map_from_entries(F.collect_list(entry)).alias("draws")), "draws")
        state = state.join(draws, "d", "left")
        attempt = "coalesce(draws[concat(u.kind, '|', u.n)], 0)"
    state = state.withColumn("kk", keyed).withColumn("r", F.when(F.size("m") > 0, F.expr(replacements("m", attempt))))
    # zipped, not looked up by position: an expression that a lambda refers to may be evaluated for every element
    put = F.array_join(F.zip_with(F.filter("cut", lambda x, i: i % 2 == 0), "r", lambda x, y: F.concat(x, F.coalesce(y, F.lit("")))), "")
    text = F.when(F.size("m") > 0, put).otherwise(F.col("row.text"))
    kinds = F.expr("coalesce(transform(filter(m, x -> x.kind IS NOT NULL), x -> x.kind), array())")
    columns = [text.alias("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns if c not in ("pii_types", "n_pii")]
    return state.select(*columns, kinds.alias("pii_types"), F.size(kinds).cast("bigint").alias("n_pii"))


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pseudonymise(docs).withColumn("pii_types", F.concat_ws(",", "pii_types"))
