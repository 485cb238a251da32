"""Personal data: entities get keyed surrogates of their own kind and format.

All of it is DataFrame functions. An entity is cut into parts that stand for
one thing each (local part and domain of an address, given name and surname,
the digits of a number), and every distinct part gets one surrogate, so equal
parts stay equal and different ones different wherever they occur. Parts are
spread over tasks; what comes out twice, or equals a part that exists, is
drawn anew until nothing does. The space that is drawn from grows with the
tries, so no part ever stays as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockline.llm.secrets import apart, blocks, let, spans
from dockline.session import materialize

# What the scan takes for an entity, in order of precedence.
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
_GROUP = "[0-9A-Fa-f]{1,4}"
CARD_OF_FOURS = "[0-9]{4}(?:[ -]?[0-9]{4}){3}"
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}",
    "iban": r"(?=[A-Z])(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
    "ip6": rf"(?=[0-9A-Fa-f])(?<![0-9A-Za-z:.])(?=[0-9A-Fa-f:]*[0-9])(?:(?:{_GROUP}:){{7}}{_GROUP}|(?:{_GROUP}:){{1,6}}(?::{_GROUP}){{1,6}})(?![0-9A-Za-z:])",
    "ip": rf"(?=[0-9])(?<![0-9A-Za-z.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9A-Za-z]|\.[0-9])",
    "card": rf"(?=[0-9])(?<![0-9A-Za-z-])(?:{CARD_OF_FOURS}|[0-9]{{4}}[ -]?[0-9]{{6}}[ -]?[0-9]{{5}}|[0-9]{{13,19}})(?![0-9A-Za-z-])",
    "phone": (
        r"(?=[0-9+(])(?<![0-9A-Za-z+(])(?:"
        r"(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}"
        r"|\+[0-9]{8,15}|(?:\+[0-9]{1,3}[ .-]?[0-9]|(?<![.-])0[0-9])(?:[ .-][0-9]{2}){4}"
        r")(?![0-9A-Za-z]|-[0-9])"),
    "ssn": r"(?=[0-9])(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
}
KINDS = (*PATTERNS, "name")
LETTERS = "abcdefghijklmnopqrstuvwxyz"

# Given names by gender and script. A name is one of them, or any after a title, with initials,
# particles and a surname after it.
GIVEN = {
    "f_latin": (
        "Alice Amanda Amelia Amy Angela Anna Barbara Brenda Carol Carolyn Catherine Charlotte Christine Claudia Cynthia Deborah "
        "Diana Donna Dorothy Elizabeth Emily Emma Gabriela Hannah Helen Isabella Jennifer Jessica Julia Karen Katherine Kimberly "
        "Laura Linda Lisa Margaret Maria Mary Melissa Michelle Nancy Natalie Nicole Olivia Pamela Patricia Rachel Rebecca Ruth "
        "Samantha Sandra Sarah Sharon Sophia Stephanie Susan Teresa Victoria Virginia").split(),
    "m_latin": (
        "Adam Alexander Andrew Anthony Arthur Benjamin Brandon Brian Carl Carlos Charles Christopher Daniel David Dennis Donald "
        "Douglas Edward Eric Eugene Frederick Gary George Gregory Harold Henry Jack Jacob James Jason Jeffrey Jeremy John Jonathan "
        "Joseph Joshua Justin Keith Kenneth Kevin Lawrence Louis Matthew Michael Nicholas Oliver Patrick Paul Peter Philip Raymond "
        "Richard Robert Roger Ronald Ryan Samuel Scott Stephen Steven Thomas Timothy Walter William Zachary").split(),
    "f_cyrillic": "Анастасия Анна Галина Дарья Екатерина Елена Ирина Ксения Людмила Мария Наталья Ольга Полина Светлана Татьяна Юлия".split(),
    "m_cyrillic": "Александр Алексей Андрей Артём Борис Виктор Владимир Дмитрий Иван Игорь Максим Михаил Николай Олег Павел Сергей Юрий".split(),
}
TITLES = "Dr|Miss|Mr|Mrs|Ms|Prof|Sir"
PARTICLES = "al|bin|da|de|del|den|der|di|du|el|la|le|ten|ter|van|von"
_ALL = [name for names in GIVEN.values() for name in names]
_LISTED = "|".join(f"{first}(?:{'|'.join(n[1:] for n in _ALL if n[0] == first)})" for first in sorted({n[0] for n in _ALL}))
_WORD = r"(?:[DLO]['’])?\p{Lu}\p{L}*\p{Ll}\p{L}*"
_SURNAME = rf"(?: \p{{Lu}}\.)* (?:(?:{PARTICLES}) )*{_WORD}(?:-{_WORD})*"
NAME = (
    rf"(?=\p{{Lu}})(?<!\p{{L}})(?:(?:{_LISTED}){_SURNAME}"
    rf"|(?<=(?<!\p{{L}})(?:{TITLES})\.? )(?:(?:{_WORD}|\p{{Lu}}\.)?{_SURNAME}|{_WORD}))(?!\p{{L}})")
WORD = rf"(?=\p{{Lu}})(?<!\p{{L}}){_WORD}(?!\p{{L}})"
# Syllables of made-up surnames, per script.
SYLLABLES = {
    "latin": "bar bel cor dan del fen gar hal ken lan mar mon nor pel ran sel tor ver wes wil".split(),
    "cyrillic": "бар бел вер гор дан ден зор кал лан мар нов пел рад сев тор фед хар чер шам яр".split(),
}
SYLLABLES_PER_NAME = 4
# After each further so many tries a surrogate is one step longer.
TRIES_PER_STEP = 3

_SPANS = "array<struct<start:int,kind:int,end:int,value:string>>"


def _any(text: Column) -> Column:
    """Whether a text may hold an entity at all."""
    out = F.lit(False)
    for pattern in (*PATTERNS.values(), NAME):
        out = out | F.regexp_like(text, F.lit(pattern))
    return out


def _part(start: Column, kind: Column | str, own: Column, value: Column | None = None) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return F.struct(
        start.cast("int").alias("start"), (start + F.length(own)).cast("int").alias("end"), kind.alias("kind"),
        (F.regexp_replace(F.lower(own), "[^a-z0-9]", "") if value is None else value).alias("value"), own.alias("own"))


def _parts_of(s: Column) -> Column:
    """The parts of one entity that are replaced; what lies between them (country codes, initials, particles) stays."""
    text, start = s["value"], s["start"]
    at = F.instr(text, F.lit("@"))
    local = F.substr(text, F.lit(1), at - 1)
    domain = F.regexp_extract(text, r"@(.*)\.[A-Za-z]+$", 1)
    code = F.regexp_extract(text, r"^(\+(?:[0-9]{1,3}(?=[ .(-])|[17]|[0-9]{2})[ .-]?)", 1)
    given, last = F.regexp_extract(text, r"^([^ .]+) ", 1), F.regexp_extract(text, r"([^ ]+)$", 1)
    first = F.when(given.isin(_ALL), "given").otherwise("surname")
    surnames = F.split(last, "-")
    before = lambda i: F.length(text) - F.length(last) + F.aggregate(
        F.slice(surnames, F.lit(1), i), F.lit(0), lambda n, x: n + F.length(x) + 1)
    kind = lambda name: s["kind"] == KINDS.index(name)
    own_given = F.when(given != "", F.array(_part(start, first, given, given))).otherwise(F.expr(f"cast(array() as {_PARTS})"))
    return (
        F.when(kind("email"), F.array(
            _part(start, "local", local, F.lower(local)), _part(start + at, "domain", domain, F.lower(domain))))
        .when(kind("iban"), F.array(_part(start, "iban", text)))
        .when(kind("ip6"), F.array(_part(start, "ip6", text, F.lower(text))))
        .when(kind("ip"), F.array(_part(start, "ip", text, text)))
        .when(kind("card"), F.array(_part(start, "card", text)))
        .when(kind("phone"), F.array(_part(start + F.length(code), "phone", F.substr(text, F.length(code) + 1))))
        .when(kind("ssn"), F.array(_part(start, "ssn", text)))
        .otherwise(F.concat(own_given, F.transform(surnames, lambda x, i: _part(start + before(i), "surname", x, x))))
    )


_PARTS = "array<struct<start:int,end:int,kind:string,value:string,own:string>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^A-Za-z0-9]", "")


def _valid(s: Column) -> Column:
    """Whether the checksum of a span is right, where its kind has one; cards in groups of four count anyway."""
    card = s["value"].rlike(f"^{CARD_OF_FOURS}$") | _luhn(_digits(s["value"]))
    return F.when(s["kind"] == KINDS.index("card"), card).when(
        s["kind"] == KINDS.index("iban"), _mod97(_turned(F.lower(_digits(s["value"])))) == 1).otherwise(True)


def detect(docs: DataFrame, text: str = "text") -> DataFrame:
    """Per distinct text that holds entities: `_node` (its hash), `found` (spans) and `parts`, what is to be replaced.

    Of entities that overlap, the kind named first stays. In a text that holds
    a full name, its given name and its surname are parts wherever else they
    stand alone. Null texts count as empty.
    """
    own = docs.select(F.coalesce(docs[text].cast("string"), F.lit("")).alias("_text")).where(_any(F.col("_text")))
    own = own.withColumn("_node", F.sha2("_text", 256))
    for i, pattern in enumerate([*PATTERNS.values(), NAME]):
        own = own.withColumn("_more", F.filter(spans(F.col("_text"), pattern, i), _valid))
        own = own.withColumn("found", apart(F.col("found"), F.col("_more"), i) if i else F.col("_more"))
    own = own.withColumn("_parts", F.flatten(F.transform("found", _parts_of)))
    named = F.filter("_parts", lambda p: p["kind"].isin("given", "surname"))
    own = own.withColumn("_names", F.array_distinct(F.transform(named, lambda p: p["own"])))
    own = own.withColumn("_givens", F.array_distinct(F.transform(F.filter(named, lambda p: p["kind"] == "given"), lambda p: p["own"])))
    words = F.when(F.size("_names") > 0, spans(F.col("_text"), WORD, len(KINDS))).otherwise(F.expr(f"cast(array() as {_SPANS})"))
    words = F.filter(words, lambda w: F.array_contains("_names", w["value"]))
    alone = F.filter(apart(F.col("found"), words, len(KINDS)), lambda w: w["kind"] == len(KINDS))
    kind = lambda w: F.when(F.array_contains("_givens", w["value"]), "given").otherwise("surname")
    alone = F.transform(alone, lambda w: _part(w["start"], kind(w), w["value"], w["value"]))
    return own.select("_node", "found", F.concat("_parts", alone).alias("parts")).dropDuplicates(["_node"])


def _digest(key: str, *columns: Column) -> Column:
    """Keyed hash of the columns, in the shape of an HMAC."""
    inner = F.sha2(F.concat_ws("\x1f", F.lit(key + "/i"), *columns), 256)
    return F.sha2(F.concat(F.lit(key + "/o"), inner), 256)


def _number(digest: Column, below: Column | int) -> Column:
    return F.pmod(F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint"), F.lit(below) if isinstance(below, int) else below)


def _draw(key: str) -> Column:
    """A surrogate of the row's kind and value, for its number of tries."""
    seed = [F.col("kind"), F.col("value"), F.col("tries").cast("string")]
    draw = lambda below, *what: _number(_digest(key, *seed, *what), below)
    letter = lambda n: F.substr(F.lit(LETTERS), n.cast("int") + 1, F.lit(1))
    hex_digit = lambda *what: F.lower(F.hex(draw(16, *what)))

    def other(c, i):
        n = i.cast("string")
        return (
            F.when(c.rlike("[0-9]"), draw(10, n).cast("string"))
            .when(c.rlike("[a-z]"), letter(draw(26, n)))
            .otherwise(c)
        )

    step = F.floor(F.col("tries") / TRIES_PER_STEP).cast("int")

    def longer(one):
        each = F.transform(F.sequence(F.lit(0), step), lambda i: F.when(i > 0, one(F.lit("more"), i.cast("string"))).otherwise(""))
        return F.array_join(each, "")

    letters = longer(lambda *what: letter(draw(26, *what)))
    digits = longer(lambda *what: draw(10, *what).cast("string"))
    plain = F.array_join(F.transform(F.split("value", ""), other), "")
    octet = lambda o, i: F.when(F.length(o) == 3, 100 + draw(156, i.cast("string"))).when(
        F.length(o) == 2, 10 + draw(90, i.cast("string"))).otherwise(draw(10, i.cast("string"))).cast("string")
    any_octet = lambda o, i: draw(256, F.lit("any"), i.cast("string")).cast("string")
    ip = F.array_join(F.when(step > 0, F.transform(F.split("value", r"\."), any_octet)).otherwise(
        F.transform(F.split("value", r"\."), octet)), ".")
    same_groups = F.array_join(F.transform(F.split("value", ""), lambda c, i: F.when(
        c == ":", c).otherwise(hex_digit(i.cast("string")))), "")
    all_groups = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.concat(
        *(hex_digit(i.cast("string"), F.lit(str(k))) for k in range(4)))), ":")
    script = F.when(F.col("value").rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin")

    def syllables(name):
        table = F.array(*(F.lit(x) for x in SYLLABLES[name]))
        pick = lambda i: F.get(table, draw(len(SYLLABLES[name]), i.cast("string")).cast("int"))
        return F.initcap(F.array_join(F.transform(F.sequence(F.lit(0), step + SYLLABLES_PER_NAME - 1), pick), ""))

    kind, number = F.col("kind"), F.concat(plain, digits)
    country = F.substring("value", 1, 2)
    body = F.substr(number, F.lit(5), F.length(number))
    check = F.lpad((98 - _mod97(F.concat(body, country, F.lit("00")))).cast("string"), 2, "0")
    return (
        F.when(kind == "ip", F.concat(ip, F.when(step > 3, F.concat(F.lit(":"), digits)).otherwise("")))
        .when(kind == "ip6", F.when(step > 0, all_groups).otherwise(same_groups))
        .when(kind == "surname", F.when(script == "cyrillic", syllables("cyrillic")).otherwise(syllables("latin")))
        .when(kind == "card", F.when(_luhn(F.col("value")), _with_check_digit(number)).otherwise(number))
        .when(kind == "iban", F.concat(country, check, body))
        .when(kind.isin("local", "domain"), F.concat(plain, letters)).otherwise(number)
    )


def _turned(iban: Column) -> Column:
    """An IBAN with its first four characters last, as its checksum reads it."""
    return F.concat(F.substr(iban, F.lit(5), F.length(iban)), F.substr(iban, F.lit(1), F.lit(4)))


def _mod97(text: Column) -> Column:
    """What remains of lower-case letters (a is 10) and digits, read as one number, divided by 97."""
    value = lambda c: F.instr(F.lit("0123456789" + LETTERS), c) - 1
    return F.aggregate(F.split(text, ""), F.lit(0), lambda n, c: (n * F.when(value(c) > 9, 100).otherwise(10) + value(c)) % 97)


def _luhn_sum(digits: Column) -> Column:
    """The Luhn sum, the last digit included."""
    each = F.transform(F.reverse(F.split(digits, "")), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        F.pmod(c.cast("int") * 2, F.lit(10)) + F.when(c.cast("int") > 4, 1).otherwise(0)))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x)


def _luhn(digits: Column) -> Column:
    return _luhn_sum(digits) % 10 == 0


def _with_check_digit(digits: Column) -> Column:
    body = F.substr(digits, F.lit(1), F.length(digits) - 1)
    return F.concat(body, F.pmod(10 - _luhn_sum(F.concat(body, F.lit("0"))) % 10, F.lit(10)).cast("string"))


def _given(key: str) -> Column:
    """Another given name of the same gender and script: the list turned by a keyed step, so no two meet."""
    out = None
    for group, names in GIVEN.items():
        step = 1 + F.pmod(F.conv(F.substring(_digest(key, F.lit(group)), 1, 12), 16, 10).cast("bigint"), F.lit(len(names) - 1))
        table = F.array(*(F.lit(n) for n in names))
        place = F.array_position(table, F.col("value"))
        other = F.get(table, F.pmod(place - 1 + step, F.lit(len(names))).cast("int"))
        out = F.when(place > 0, other) if out is None else out.when(place > 0, other)
    return out


def surrogates(parts: DataFrame, key: str) -> DataFrame:
    """kind, value, surrogate for the distinct (kind, value) of parts; one to one within a kind.

    A surrogate that another part of the kind has too, or that is itself a
    part of the kind, is drawn anew: of those that meet, the one with the
    smallest value keeps it. After every TRIES_PER_STEP tries the draw is from
    a space of values that are longer by one (an address gets any octets, later
    a port), so all find one, also where every value of a format exists, and
    no surrogate but a listed given name is a value of the table.
    """
    values = materialize(parts.select("kind", "value").distinct(), "parts")
    given = values.where("kind = 'given'").withColumn("surrogate", _given(key))
    rest = values.where("kind <> 'given'")
    open_, done = rest.withColumn("tries", F.lit(0)), None
    while done is None or not open_.isEmpty():
        drawn = materialize(open_.withColumn("surrogate", _draw(key)), "drawn")
        taken = rest.select("kind", F.col("value").alias("surrogate"))
        if done is not None:
            taken = taken.unionByName(done.select("kind", "surrogate"))
        free = drawn.join(taken, ["kind", "surrogate"], "left_anti")
        got = free.groupBy("kind", "surrogate").agg(F.min("value").alias("value")).select("kind", "value", "surrogate")
        done = materialize(got if done is None else done.unionByName(got), "surrogates")
        open_ = drawn.drop("surrogate").join(done, ["kind", "value"], "left_anti").withColumn("tries", F.col("tries") + 1)
    return given.unionByName(done)


def _dressed(own: Column, surrogate: Column) -> Column:
    """The surrogate's letters and digits in the places and the case of the original's; what is longer follows."""
    letters = F.regexp_replace(surrogate, "[^a-z0-9]", "")

    def step(acc, c):
        takes = c.rlike("[A-Za-z0-9]")
        next_ = F.substr(letters, acc["i"] + 1, F.lit(1))
        shown = F.when(c.rlike("[A-Z]"), F.upper(next_)).otherwise(next_)
        return F.struct(F.concat(acc["out"], F.when(takes, shown).otherwise(c)).alias("out"), (acc["i"] + takes.cast("int")).alias("i"))

    capitals = own.rlike("[A-Z]") & ~own.rlike("[a-z]")
    rest = lambda acc: F.substr(letters, acc["i"] + 1, F.lit(1 << 20))
    return F.aggregate(
        F.split(own, ""), F.struct(F.lit("").alias("out"), F.lit(0).alias("i")), step,
        lambda acc: F.concat(acc["out"], F.when(capitals, F.upper(rest(acc))).otherwise(rest(acc))))


def replace(docs: DataFrame, key: str, keep: list[str], text: str = "text") -> DataFrame:
    """Columns `keep`, the text with surrogates (`surrogate_text`), and per kind how many entities it held.

    A null text counts as empty and comes back empty. Equal texts get equal
    results and repeated rows stay; the table of parts is built once per
    distinct text. Another key gives other surrogates.
    """
    made = ("surrogate_text", "entities", *(f"n_{k}" for k in KINDS))
    keep = [c for c in keep if c not in made]
    own = docs.select(*(docs[c] for c in keep), F.coalesce(docs[text].cast("string"), F.lit("")).alias("_text"))
    maybe = materialize(own.where(_any(F.col("_text"))), "maybe")
    found = materialize(detect(maybe, "_text"), "entities")
    rows = found.select("_node", F.explode("parts").alias("p")).select("_node", "p.*")
    named = rows.join(surrogates(rows, key), ["kind", "value"]).select(
        "_node", F.struct("start", "end", F.when(F.col("kind").isin("given", "surname", "ip", "ip6"), F.col("surrogate")).otherwise(
            _dressed(F.col("own"), F.col("surrogate"))).alias("new")).alias("r"))
    news = named.groupBy("_node").agg(F.array_sort(F.collect_list("r")).alias("_r"))  # as many as one text has parts

    def count(kind):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("bigint")

    kind = lambda s: F.get(F.array(*(F.lit(k) for k in KINDS)), s["kind"])
    where = F.array_join(F.transform(F.array_sort("found"), lambda s: F.concat_ws(":", kind(s), s["start"].cast("string"), s["end"].cast("string"))), ",")
    counts = {f"n_{k}": count(i) for i, k in enumerate(KINDS)}
    # a table of its own, so that the join below can split a text that very many rows have
    per_text = materialize(found.join(news, "_node").select(
        "_node", "_r", where.alias("entities"), *(v.alias(k) for k, v in counts.items())), "news")

    froms = F.concat(F.array(F.lit(0)), F.transform("_r", lambda x: x["end"]))
    tos = F.concat(F.transform("_r", lambda x: x["start"]), F.array(F.length("_text")))
    news_ = F.concat(F.transform("_r", lambda x: x["new"]), F.array(F.lit("")))
    cuts = F.zip_with(F.arrays_zip(froms.alias("from"), tos.alias("to")), news_, lambda c, n: F.struct(
        c["from"].alias("from"), c["to"].alias("to"), n.alias("new")))

    def patched(block):
        low, high = F.get(block, F.lit(0))["from"], F.element_at(block, -1)["to"]
        return let(F.substr("_text", low + 1, high - low), lambda part: F.transform(
            block, lambda x: F.concat(F.substr(part, x["from"] - low + 1, x["to"] - x["from"]), x["new"])))

    new_text = let(cuts, lambda c: F.array_join(F.flatten(F.transform(blocks(c), patched)), ""))
    maybe = maybe.withColumn("_node", F.sha2("_text", 256)).join(per_text, "_node", "left")
    changed = maybe.select(
        *keep, F.when(F.col("_r").isNotNull(), new_text).otherwise(F.col("_text")).alias("surrogate_text"),
        F.coalesce("entities", F.lit("")).alias("entities"), *(F.coalesce(k, F.lit(0)).alias(k) for k in counts))
    same = own.where(~_any(F.col("_text"))).select(
        *keep, F.col("_text").alias("surrogate_text"), F.lit("").alias("entities"), *(F.lit(0).cast("bigint").alias(k) for k in counts))
    return same.unionByName(changed)
