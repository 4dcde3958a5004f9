"""Personal data replaced by keyed surrogates of the same type and format, with DataFrame functions alone.

Entities are found by patterns. An entity's canonical form (digits of a number, a phone's without its country; the
lower case of an address or name; a secret as it is) and a key decide its surrogate, so one entity gets one surrogate
in every document. Given and family names are entities of their own, so that "Mr Smith" and "Mr. John Smith" keep one
family name; titles, countries and signs stay. A surrogate has its entity's type and script and, for given names,
gender; numbers and secrets keep their length, secrets the case of their letters, cards a valid check digit; names
and mail addresses may change in length. Surrogates are checked over all entities of the corpus: one that another
entity has, or that is itself an entity of the corpus, is drawn anew, so different entities stay different. Names get
a further syllable and addresses wider reserved blocks with each further draw, so that few names to draw from can't run
out; numbers keep their digits, so theirs outnumber entities while those take less than half of their numbers.

Defined results: a null text stays null and has no entities; texts without entities stay as they are; repeated rows
are rewritten one by one; rows with a null doc_id are rewritten too; an empty table gives none; other columns are
ignored here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

# Titles by gender, given and family names by script.
TITLES = {"n": ("Dr", "Prof"), "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Señora", "госпожа"), "m": ("Mr", "Herr", "Monsieur", "Señor", "господин")}
GIVEN = {
    "latin_f": ("Anna", "Clara", "Elena", "Ida", "Julia", "Laura", "Maria", "Nora", "Olga", "Rosa", "Sofia", "Vera"),
    "latin_m": ("Adam", "Bruno", "David", "Emil", "Hugo", "Jonas", "Karl", "Leo", "Max", "Oscar", "Paul", "Tomas"),
    "cyrillic_f": ("Анна", "Вера", "Елена", "Ирина", "Мария", "Нина", "Ольга", "София"),
    "cyrillic_m": ("Андрей", "Борис", "Иван", "Михаил", "Олег", "Павел", "Роман", "Сергей"),
}
FAMILY_PARTS = {"latin": (("Al", "Ber", "Cor", "Del", "Fen", "Gar", "Hol", "Lin", "Mar", "Nor", "Ros", "Sten"), ("ba", "den", "field", "kin", "lo", "man", "ra", "son", "ta", "vik")),
                "cyrillic": (("Бел", "Вол", "Гор", "Дуб", "Кор", "Лес", "Мор", "Сол"), ("енко", "ин", "ов", "ский", "ук"))}
#: Added to a family name for each turn after the first, at most so many that it stays a name of the pattern.
SYLLABLES = {"latin": ("be", "da", "fi", "go", "ka", "li", "mo", "nu", "pe", "ro", "sa", "ti"), "cyrillic": ("ба", "ве", "ди", "ко", "ла", "ми", "ро", "ту")}
MOST_SYLLABLES = 10

_TITLE = "|".join(t for group in TITLES.values() for t in group)
#: Type and pattern, in the order in which they claim text. Every run is bounded, so long texts cost their length.
PATTERNS = (
    ("email", r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,64}@(?:[\p{L}\p{N}-]{1,63}\.){1,8}\p{L}{2,24}"),
    ("secret", r"(?<![0-9A-Za-z])(?:[0-9a-f]{40}|[0-9a-f]{64}|[0-9a-f]{32}|AKIA[0-9A-Z]{16}|ghp_[0-9A-Za-z]{36}|sk-[0-9A-Za-z]{20,64})(?![0-9A-Za-z])"),
    ("ip", r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?!\.?\d)"),
    ("card", r"(?<![\d+])(?:\d{16}|\d{4} \d{4} \d{4} \d{4}|\d{4}-\d{4}-\d{4}-\d{4})(?!\d)"),
    ("phone", r"(?<![\d+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)|\d{3})[ .-]?\d{3}[ .-]\d{4}(?!\d)"),
    ("name", rf"\b(?:{_TITLE})\.? \p{{Lu}}\p{{Ll}}{{1,30}}(?: \p{{Lu}}\p{{Ll}}{{1,30}})?"),
)
ANY = "|".join(p for _, p in PATTERNS)


def kind_of(value: Column) -> Column:
    kind = F.lit("name")
    for name, pattern in reversed(PATTERNS[:-1]):
        kind = F.when(value.rlike(f"^(?:{pattern})$"), F.lit(name)).otherwise(kind)
    return kind


#: A phone's country, which stays.
_COUNTRY = r"^\+\d{1,3}[ .-]?(?=(?:\(\d{2,4}\)|\d{3})[ .-]?\d{3}[ .-]\d{4}$)"


def canonical(kind: Column, value: Column) -> Column:
    digits = F.regexp_replace(F.when(kind == "phone", F.regexp_replace(value, _COUNTRY, "")).otherwise(value), r"\D", "")
    return F.when(kind.isin("card", "phone"), digits).when(kind == "secret", value).otherwise(F.lower(value))


def _parts(kind: Column, value: Column) -> Column:
    """What of a found entity is replaced, as (kind, before, value): the names of a titled name, else the whole."""
    words = F.split(value, " ")
    title = F.regexp_replace(F.get(words, F.lit(0)), r"\.$", "")
    gender = F.when(title.isin(*TITLES["f"]), "f").when(title.isin(*TITLES["m"]), "m").otherwise("n")
    script = lambda w: F.when(w.rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin")

    def named(w: Column, i: Column) -> Column:
        before = F.when(i == 0, F.concat(F.get(words, F.lit(0)), F.lit(" "))).otherwise(F.lit(" "))
        given = i < F.size(words) - 2
        return F.struct(F.when(given, F.concat(F.lit("given_"), script(w), F.lit("_"), gender)).otherwise(F.concat(F.lit("family_"), script(w))).alias("kind"), before.alias("before"), w.alias("value"))

    whole = F.array(F.struct(kind.alias("kind"), F.lit("").alias("before"), value.alias("value")))
    return F.when(kind == "name", F.transform(F.slice(words, 2, F.size(words)), named)).otherwise(whole)


def _pick(names: tuple, h: Column, at: int | Column) -> Column:
    number = F.conv(F.substring(h, at, 6), 16, 10).cast("int")
    return F.element_at(F.array(*[F.lit(x) for x in names]), (number % len(names) + 1).cast("int"))


def _syllables(names: tuple, h: Column, turn: Column) -> Column:
    """None in turn 0, then one a turn: the pool grows by the factor len(names) with each."""
    picked = F.transform(F.sequence(F.lit(1), F.least(F.greatest(turn, F.lit(1)), F.lit(MOST_SYLLABLES))), lambda i: _pick(names, h, i * 6 - 5))
    return F.when(turn > 0, F.array_join(picked, "")).otherwise(F.lit(""))


def _surrogate(kind: Column, value: Column, key: str, turn: Column) -> Column:
    """A canonical surrogate of a canonical value: same type, length class and script."""
    h = F.sha2(F.concat_ws("\x1f", F.lit(key), kind, value, turn.cast("string")), 256)
    more = F.sha2(F.concat(h, F.lit("+")), 256)
    digits = F.translate(F.concat(h, more), "abcdef", "051938")
    octet = lambda at: F.conv(F.substring(h, at, 2), 16, 10)
    local = F.concat(F.translate(F.substring(h, 1, 2), "0123456789", "ghijklmnop"), F.substring(h, 3, 10))
    out = F.when(kind == "email", F.concat(local, F.lit("@mail."), _pick(("com", "org", "net"), h, 20), F.lit(".example")))
    # private addresses, then reserved ones, and any only where both are used up
    some = F.conv(F.substring(h, 7, 2), 16, 10).cast("int")
    first = F.when(turn <= 3, F.lit("10")).when(turn <= 8, (240 + some % 16).cast("string")).otherwise(some.cast("string"))
    out = out.when(kind == "ip", F.concat_ws(".", first, octet(1), octet(3), octet(5)))
    # a secret letter by letter: digits from digits, letters of either case from letters, hexadecimal ones from a to f
    head = F.regexp_extract(value, r"^(AKIA|ghp_|sk-)?", 0)
    long_ = F.concat(h, more)

    def drawn(c: Column, i: Column) -> Column:
        x = long_.substr(i + 1, F.lit(1))
        letter = F.when(value.rlike("^[0-9a-f]+$"), F.translate(x, "0123456789", "abcdefabcd")).otherwise(F.translate(x, "0123456789", "ghijklmnop"))
        return F.when(c.rlike("[0-9]"), F.translate(x, "abcdef", "051938")).otherwise(F.when(c.rlike("[A-Z]"), F.upper(letter)).otherwise(letter))

    rest = F.split(F.substr(value, F.length(head) + 1), "")
    out = out.when(kind == "secret", F.concat(head, F.array_join(F.transform(rest, drawn), "")))
    out = out.when(kind == "phone", digits.substr(F.lit(1), F.length(value)))
    payload = digits.substr(F.lit(1), F.length(value) - 1)
    out = out.when(kind == "card", F.when(_checked(value), F.concat(payload, _check_digit(payload))).otherwise(digits.substr(F.lit(1), F.length(value))))
    more_letters = F.when(kind.contains("cyrillic"), _syllables(SYLLABLES["cyrillic"], more, turn)).otherwise(_syllables(SYLLABLES["latin"], more, turn))
    given = F.lit("")
    for script in ("latin", "cyrillic"):
        for gender in "fmn":
            names = GIVEN[f"{script}_{gender}"] if gender != "n" else GIVEN[f"{script}_f"] + GIVEN[f"{script}_m"]
            given = F.when(kind == f"given_{script}_{gender}", _pick(names, h, 1)).otherwise(given)
    family = F.when(kind == "family_cyrillic", F.concat(_pick(FAMILY_PARTS["cyrillic"][0], h, 8), _pick(FAMILY_PARTS["cyrillic"][1], h, 15))).otherwise(
        F.concat(_pick(FAMILY_PARTS["latin"][0], h, 8), _pick(FAMILY_PARTS["latin"][1], h, 15), F.substring(F.translate(h, "0123456789", "aeioulnrst"), 30, 2))
    )
    return out.otherwise(F.concat(F.when(kind.startswith("given"), given).otherwise(family), more_letters))


def _check_digit(payload: Column) -> Column:
    """The last digit that makes a card number valid: every other digit from the right counts twice, nines cast out."""
    twice = lambda d: F.when(d > 4, 2 * d - 9).otherwise(2 * d)
    digits = F.transform(F.split(F.reverse(payload), ""), lambda c, i: F.when(i % 2 == 0, twice(c.cast("int"))).otherwise(c.cast("int")))
    return (F.pmod(-F.aggregate(digits, F.lit(0), lambda a, d: a + d), F.lit(10))).cast("string")


def _checked(number: Column) -> Column:
    return _check_digit(number.substr(F.lit(1), F.length(number) - 1)) == number.substr(F.length(number), F.lit(1))


def _written(kind: Column, value: Column, surrogate: Column) -> Column:
    """The surrogate in the written form of the value: digits go where digits stood, the last ones first to their places."""
    upto = lambda i: F.length(F.regexp_replace(value.substr(F.lit(1), i + 1), r"\D", ""))
    ahead = F.length(F.regexp_replace(value, r"\D", "")) - F.length(surrogate)  # digits of a phone's country
    laid = F.transform(F.split(value, ""), lambda c, i: F.when(c.rlike(r"^\d$") & (upto(i) > ahead), surrogate.substr(upto(i) - ahead, F.lit(1))).otherwise(c))
    return F.when(kind.isin("card", "phone"), F.array_join(laid, "")).otherwise(surrogate)


def surrogate_table(entities: DataFrame, key: str) -> DataFrame:
    """(kind, canonical) -> surrogate, no two of one kind alike and none an entity of the corpus."""
    real = stored(entities.select("kind", "canonical").distinct(), "entities")
    left = real.withColumn("turn", F.lit(0))
    done = None
    while True:
        drawn = left.withColumn("surrogate", _surrogate(F.col("kind"), F.col("canonical"), key, F.col("turn")))
        drawn = drawn.withColumn("form", canonical(F.col("kind"), F.col("surrogate")))
        first = F.row_number().over(Window.partitionBy("kind", "form").orderBy("canonical")) == 1
        drawn = drawn.withColumn("first", first)
        taken = real.select("kind", F.col("canonical").alias("form"), F.lit(True).alias("taken"))
        if done is not None:
            taken = taken.union(done.select("kind", F.col("form"), F.lit(True)))
        drawn = stored(drawn.join(taken.distinct(), ["kind", "form"], "left").withColumn("fine", F.col("first") & F.col("taken").isNull()), "drawn")
        fine = drawn.where("fine").select("kind", "canonical", "surrogate", "form")
        done = fine if done is None else done.union(fine)
        left = drawn.where("not fine").select("kind", "canonical", (F.col("turn") + 1).alias("turn"))
        if left.isEmpty():
            return done.select("kind", "canonical", "surrogate")


def replace(docs: DataFrame, key: str = "loomspan") -> DataFrame:
    """doc_id, n_entities, one count a type and the rewritten text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    touched = F.coalesce(F.col("text").rlike(ANY), F.lit(False))
    names = [name for name, _ in PATTERNS]
    plain = rows.where(~touched).select("doc_id", F.lit(0).cast("long").alias("n_entities"), *[F.lit(0).cast("long").alias(f"n_{n}") for n in names], "text")
    found = stored(rows.where(touched).withColumn("row", F.monotonically_increasing_id()), "touched")
    each = found.select("row", F.posexplode(F.regexp_extract_all("text", F.lit(ANY), F.lit(0))).alias("at", "value"))
    each = each.withColumn("type", kind_of(F.col("value")))
    each = each.select("row", "at", "type", F.posexplode(_parts(F.col("type"), F.col("value"))).alias("part", "p")).select("row", "at", "type", "part", "p.*")
    each = stored(each.withColumn("canonical", canonical(F.col("kind"), F.col("value"))), "found")
    table = surrogate_table(each, key)
    written = each.join(table, ["kind", "canonical"]).withColumn("written", F.concat("before", _written(F.col("kind"), F.col("value"), F.col("surrogate"))))
    counts = [F.count_if((F.col("type") == n) & (F.col("part") == 0)).cast("long").alias(f"n_{n}") for n in names]
    new = F.sort_array(F.collect_list(F.struct("at", "part", "written"))).alias("new")  # one text
    per_row = written.groupBy("row").agg(F.count_if(F.col("part") == 0).cast("long").alias("n_entities"), *counts, new)
    kept = F.split("text", ANY)
    laid = found.join(per_row, "row").select("doc_id", "n_entities", *[f"n_{n}" for n in names], "new", F.explode(F.array(kept)).alias("kept"))
    pieces = F.transform("new", lambda x: F.concat(F.when(x["part"] == 0, F.get("kept", x["at"])).otherwise(F.lit("")), x["written"]))
    text = F.concat(F.array_join(pieces, ""), F.element_at("kept", -1)).alias("text")
    changed = laid.select("doc_id", "n_entities", *[f"n_{n}" for n in names], text)
    return plain.union(changed)
