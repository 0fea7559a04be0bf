"""Personal data replaced by keyed surrogates (operator 6, DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapewright.llm.tables import stage

_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
# Possessive, and tried only where a run of its characters begins or the last match ended: linear, and
# no recursion on long runs or many labels. Marks before the first letter or digit stay as they are.
EMAIL = ("(?:\\G|(?<![A-Za-z0-9._%+-]))[._%+-]*+[A-Za-z0-9][A-Za-z0-9._%+-]*+"
         "@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++")
PHONE = ("(?<![0-9])(?:\\+[0-9]{1,3}[ .-]?)?\\([0-9]{3}\\)[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])"
         "|(?<![0-9])(?:\\+[0-9]{1,3}[ .-])?[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])|\\+[0-9]{10,14}(?![0-9])")
ADDRESS = f"(?<![0-9.]){_OCTET}(?:\\.{_OCTET}){{3}}(?!\\.?[0-9])"
SOCIAL = "(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
CARD = "(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])"
_TITLES = {"m": "Mr|Herr|Monsieur|Señor|Sr|г-н|Κύριος", "f": "Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Sra|г-жа|Κυρία"}
PERSON = (f"(?<![\\p{{L}}])(?:{_TITLES['m']}|{_TITLES['f']})\\.? "
          "\\p{Lu}[\\p{Ll}'-]+(?: \\p{Lu}[\\p{Ll}'-]+)?")
ENTITY = "|".join([EMAIL, PHONE, ADDRESS, SOCIAL, CARD, PERSON])
_GUARD = f"[0-9@]|{_TITLES['m']}|{_TITLES['f']}"
KINDS = ("email", "phone", "address", "social", "card", "person_m", "person_f")

# Given names by gender and script, and syllables for family names by script.
GIVEN = {"m": {"latin": ["Adam", "Bruno", "Carl", "David", "Emil", "Frank", "Hugo", "Ivan"],
               "cyrillic": ["Антон", "Борис", "Виктор", "Глеб", "Иван", "Олег"],
               "greek": ["Ανδρέας", "Γιώργος", "Νίκος", "Πέτρος"]},
         "f": {"latin": ["Alice", "Berta", "Clara", "Diana", "Emma", "Flora", "Greta", "Ida"],
               "cyrillic": ["Анна", "Вера", "Дарья", "Елена", "Нина", "Ольга"],
               "greek": ["Άννα", "Ελένη", "Μαρία", "Σοφία"]}}
SYLLABLES = {"latin": ["ba", "den", "fo", "gar", "hel", "ka", "lin", "mor", "ne", "ros", "sal", "ter", "vi", "wen", "zo", "per"],
             "cyrillic": ["ба", "вел", "го", "дер", "ки", "лен", "мо", "ров", "са", "тин"],
             "greek": ["βα", "γο", "δη", "κα", "λι", "μο", "ρα", "σι", "το", "φα"]}


def kind_of(mention: Column) -> Column:
    def whole(p):
        return mention.rlike(f"^(?:{p})$")
    return (F.when(mention.contains("@"), "email").when(whole(PERSON), F.when(
        mention.rlike(f"^(?:{_TITLES['m']})\\.? "), "person_m").otherwise("person_f"))
        .when(whole(ADDRESS), "address").when(whole(SOCIAL), "social").when(whole(PHONE), "phone").otherwise("card"))


def _marks(mention: Column) -> Column:
    return F.regexp_extract(mention, "^[._%+-]*", 0)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _name(mention: Column) -> Column:
    return F.regexp_replace(mention, "^\\S+ ", "")


def normal(mention: Column, kind: Column) -> Column:
    """What mentions of one entity share: lower-case address, digits only, name without title."""
    return (F.when(kind == "email", F.lower(F.ltrim(mention, F.lit("._%+-")))).when(kind == "address", mention)
            .when(kind.startswith("person"), F.lower(_name(mention))).otherwise(_digits(mention)))


def _nibble(digest: Column, at) -> Column:
    """A number from two hex digits of a 64-digit digest."""
    return F.conv(F.substring(digest, (at * 2) % 62 + 1, F.lit(2)), 16, 10).cast("int")


def _spelled(text: Column, digest: Column) -> Column:
    """Every letter and digit of lower-case ``text`` replaced by one of its own class."""
    def one(c, i):
        n = F.pmod(_nibble(digest, i) + i, F.lit(260))
        return (F.when(c.rlike("[0-9]"), F.pmod(n, F.lit(10)).cast("string"))
                .when(c.rlike("[a-z]"), F.char(F.lit(97) + F.pmod(n, F.lit(26)))).otherwise(c))
    return F.array_join(F.transform(F.split(text, ""), one), "")


def _luhn(body: Column) -> Column:
    """``body`` with its last digit set so that the check sum of card numbers holds."""
    head = F.substring(body, 1, F.length(body) - 1)
    total = F.aggregate(F.transform(F.split(F.reverse(head), ""), lambda c, i: F.when(
        i % 2 == 0, (c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5).cast("int")).otherwise(c.cast("int"))),
        F.lit(0), lambda a, x: a + x)
    return F.concat(head, F.pmod(-total, F.lit(10)).cast("string"))


def _by_script(name: Column, made) -> Column:
    return (F.when(name.rlike("\\p{IsCyrillic}"), made("cyrillic")).when(name.rlike("\\p{IsGreek}"), made("greek"))
            .otherwise(made("latin")))


def _pick(values: list[str], digest: Column, at) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), F.pmod(_nibble(digest, at), F.lit(len(values))) + 1)


def _syllables(script: str, digest: Column, count: Column) -> Column:
    return F.array_join(F.transform(F.sequence(F.lit(1), count), lambda i: _pick(SYLLABLES[script], digest, i)), "")


def _family(surname: Column, digest: Column, attempt: Column) -> Column:
    return _by_script(surname, lambda script: F.initcap(_syllables(script, digest, F.lit(3) + attempt)))


def _given(name: Column, kind: Column, digest: Column, attempt: Column) -> Column:
    """A given name of the list; drawn again, with more syllables behind it each time."""
    def of(gender):
        return _by_script(name, lambda script: F.concat(
            _pick(GIVEN[gender][script], digest, F.lit(20)),
            F.when(attempt > 0, _syllables(script, digest, 2 * attempt)).otherwise("")))
    return F.when(kind == "person_m", of("m")).otherwise(of("f"))


def surrogate(kind: Column, norm: Column, attempt: Column, key: str) -> Column:
    """The replacement of an entity: keyed, of its kind, as long as it where that is a format.

    Mail addresses of few letters have few forms, so each further draw has one more letter in the user.
    Of a person's norm with a space it is the given name, of a surname (kinds family_m, family_f) the family name.
    """
    digest = F.sha2(F.concat_ws("|", F.lit(key), kind, norm, attempt.cast("string")), 256)
    user = F.substring_index(norm, "@", 1)
    top = F.concat(F.lit("."), F.substring_index(norm, ".", -1))
    domain = F.substring(norm, F.length(user) + 2, F.length(norm) - F.length(user) - 1 - F.length(top))
    second = F.sha2(digest, 256)
    more = F.when(attempt > 0, _spelled(F.repeat(F.lit("x"), attempt), F.sha2(second, 256))).otherwise("")
    octets = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (
        F.pmod(_nibble(digest, i), F.lit(254)) + 1).cast("string")), ".")
    return (F.when(kind == "email", F.concat(_spelled(user, digest), more, F.lit("@"), _spelled(domain, second), top))
            .when(kind == "address", octets).when(kind == "card", _luhn(_spelled(norm, digest)))
            .when(kind.startswith("family"), _family(norm, digest, attempt))
            .when(kind.startswith("person"), _given(F.substring_index(norm, " ", 1), kind, digest, attempt))
            .otherwise(_spelled(norm, digest)))


def _rendered(mention: Column, kind: Column, new: Column) -> Column:
    """The replacement in the writing of the mention: its separators, title and capitals."""
    filled = F.array_join(F.transform(F.split(mention, ""), lambda c, i: F.when(
        c.rlike("[0-9]"), F.substring(new, F.length(_digits(F.substring(mention, F.lit(1), i + 1))), F.lit(1)))
        .otherwise(c)), "")
    title = F.regexp_extract(mention, "^\\S+ ", 0)
    return (F.when(kind == "email", F.concat(_marks(mention), F.when(
        mention == F.upper(mention), F.upper(new)).otherwise(new)))
            .when(kind == "address", new).when(kind.startswith("person"), F.concat(title, new)).otherwise(filled))


def _distinct(entities: DataFrame, within: list[str], key: str) -> DataFrame:
    """``entities`` with ``new``, which no two of one ``within`` share and which is no norm of the same family of kinds.

    Entities whose surrogate collides draw again, all but the first of a collision, until none does.
    """
    columns = [*dict.fromkeys(["kind", "norm", "family", *within])]
    known = stage(entities.select(*columns).withColumn("attempt", F.lit(0)), "entities")
    real = known.select(F.col("family").alias("real_family"), F.col("norm").alias("real")).distinct()
    while True:
        drawn = known.withColumn("new", surrogate(F.col("kind"), F.col("norm"), F.col("attempt"), key))
        same = Window.partitionBy(*within, F.lower("new")).orderBy("kind", "norm")
        checked = (drawn.withColumn("n", F.row_number().over(same))
                   .join(real, (F.lower("new") == F.col("real")) & (F.col("family") == F.col("real_family")), "left"))
        checked = stage(checked.withColumn("again", (F.col("n") > 1) | F.col("real").isNotNull())
                        .select(*columns, "attempt", "new", "again"), "entity-draws")
        if checked.filter("again").isEmpty():
            return checked.select(*columns, "new")
        known = checked.select(*columns, (F.col("attempt") + F.col("again").cast("int")).alias("attempt"))


def mapping(entities: DataFrame, key: str) -> DataFrame:
    """(kind, norm, new) of distinct entities (kind, norm); no two share a surrogate and none is a real entity.

    ``new`` is what is written. The family name of a person is drawn from kind and surname, so full
    and short mentions agree; it is no other surname's, of either gender, and no real surname. The
    given name tells those of one surname apart. So a one-word name is its family name alone, and
    no full name is a real one.
    """
    known = stage(entities.select("kind", "norm").distinct(), "entities")
    person = F.col("kind").startswith("person")
    persons = known.filter(person).withColumn("surname", F.substring_index("norm", " ", -1))
    surnames = persons.select(F.regexp_replace("kind", "^person", "family").alias("kind"),
                              F.col("surname").alias("norm")).distinct()
    single = known.filter(~person).union(surnames).withColumn("family", F.regexp_replace("kind", "^(family|person)_.$", "$1"))
    single = _distinct(single, ["family"], key)
    families = single.filter("family = 'family'").select(
        F.regexp_replace("kind", "^family", "person").alias("kind"), F.col("norm").alias("surname"), F.col("new").alias("last"))
    given = _distinct(persons.filter("norm <> surname").withColumn("family", F.lit("person")), ["kind", "surname"], key)
    named = (persons.join(families, ["kind", "surname"])
             .join(given.select("kind", "norm", F.col("new").alias("first")), ["kind", "norm"], "left")
             .select("kind", "norm", F.concat_ws(" ", "first", "last").alias("new")))
    return single.filter("family <> 'family'").select("kind", "norm", "new").union(named)


def replace(docs: DataFrame, key: str = "surrogates") -> DataFrame:
    """``docs`` with the entities of ``text`` replaced, and ``entities``: kinds in order of place.

    One entity has one surrogate wherever and however it is written; different entities have
    different ones. A name behind a title is one or two words, and the last is the surname: 'Mr Smith'
    gets the family name that every 'Mr ... Smith' gets. Texts and addresses of any length are searched in
    time that grows with their length. Null texts stay null and empty ones empty, with no entities. Rows equal in id
    and text get the same result. An empty table gives none. An own column named ``entities`` is
    replaced; other extra columns stay as they are.
    """
    plain = [c for c in docs.columns if c != "entities"]
    keyed = docs.select(*[docs[c] for c in plain]).withColumn(
        "__has", F.coalesce(F.col("text").rlike(_GUARD), F.lit(False)))
    none = keyed.filter("not __has").drop("__has").withColumn("entities", F.array().cast("array<string>"))
    some = keyed.filter("__has").drop("__has").withColumns({
        "__id": F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "__k1": F.xxhash64("text"),
        "__k2": F.xxhash64(F.lit(1), "text")})
    row = ["__id", "__k1", "__k2"]
    found = some.select(*row, F.posexplode(F.regexp_extract_all("text", F.lit(ENTITY), 0)).alias("at", "mention"))
    found = found.dropDuplicates([*row, "at"]).withColumn("kind", kind_of(F.col("mention")))
    found = stage(found.withColumn("norm", normal(F.col("mention"), F.col("kind"))), "mentions")
    written = (found.join(mapping(found, key), ["kind", "norm"])
               .withColumn("new", _rendered(F.col("mention"), F.col("kind"), F.col("new")))
               .groupBy(*row).agg(F.array_sort(F.collect_list(F.struct("at", "kind", "new"))).alias("__new")))
    parts = F.split("text", ENTITY, -1)
    text = F.array_join(F.transform(parts, lambda part, i: F.concat(part, F.coalesce(
        F.get(F.col("__new"), i)["new"], F.lit("")))), "")
    joined = some.join(written, row, "left")
    changed = joined.withColumn("entities", F.coalesce(
        F.transform("__new", lambda x: x["kind"]), F.array().cast("array<string>"))).withColumn(
            "text", F.when(F.col("__new").isNull(), F.col("text")).otherwise(text))
    return none.unionByName(changed.select(*plain, "entities"))
