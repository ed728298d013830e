"""Resolution of company names to catalogue codes."""

from pyspark.sql import DataFrame, functions as F

from navlake.functions.text import strip, without_company_suffix


def resolve_company(
    names: DataFrame, catalogue: DataFrame, aliases: DataFrame | None = None
) -> DataFrame:
    """Distinct ``name`` values with the company they mean, or an error text.

    ``key`` is what is looked up: the name after aliases, in lower case. Tried in order:
    full name in any case, name without its suffix, unique prefix.
    A prefix is looked up with an equi-join against the prefixes of the catalogue names,
    already counted per prefix, so no pair of names is ever compared.
    ``catalogue`` holds ``name`` and a unique ``code``; ``aliases`` maps ``alias`` to ``name``.
    """
    keyed = _keyed(names, aliases)
    listed = catalogue.select(
        F.col("name").alias("company"), F.col("code"), F.lower("name").alias("lower_name")
    )
    spellings = listed.select(
        "code",
        F.explode(F.array_distinct(F.array(
            "lower_name", without_company_suffix(F.col("lower_name"))))).alias("key"),
    )
    # The catalogue's first entry wins where two share a spelling.
    exact = spellings.groupBy("key").agg(F.min("code").alias("exact_code"))
    found = keyed.join(exact, "key", "left")

    open_keys = found.where("exact_code is null").select("key").distinct()
    # Counted before they are joined: a short prefix that every name has is one row per task.
    prefixes = (
        _prefixes(listed, open_keys).groupBy("key")
        .agg(F.count(F.lit(1)).alias("candidates"), F.min("code").alias("prefix_code"))
        .join(open_keys, "key", "left_semi")
    )
    resolved = found.join(prefixes, "key", "left").select(
        "name", "key",
        F.coalesce("exact_code", F.when(F.col("candidates") == 1, F.col("prefix_code")))
        .alias("code"),
        F.when(F.col("exact_code").isNotNull(), F.lit(1))
        .otherwise(F.coalesce("candidates", F.lit(0))).cast("long").alias("candidates"),
    )
    error = (
        F.when(F.col("candidates") > 1, F.lit("ambiguous"))
        .when(F.col("candidates") == 0, F.lit("unknown"))
    )
    return resolved.join(listed.select("code", "company"), "code", "left").select(
        "name", "key", "company", "code", "candidates", error.alias("error")
    )


def company_candidates(
    names: DataFrame, catalogue: DataFrame, aliases: DataFrame | None = None
) -> DataFrame:
    """The companies behind each ambiguous ``key``, one row per candidate.

    Keys are distinct, so a company appears at most once per letter of its name, however
    many names ask.
    """
    ambiguous = (
        resolve_company(names, catalogue, aliases).where("error = 'ambiguous'")
        .select("key").distinct()
    )
    listed = catalogue.select(
        F.col("name").alias("company"), "code", F.lower("name").alias("lower_name")
    )
    return _prefixes(listed, ambiguous, "company").join(ambiguous, "key", "left_semi").select(
        "key", "company", "code"
    )


def unresolved_companies(
    master: DataFrame, catalogue: DataFrame, aliases: DataFrame | None = None
) -> DataFrame:
    """Fund houses of the master that resolve to no company, with the reason."""
    houses = master.where(F.col("fund_house").isNotNull()).select(
        F.col("fund_house").alias("name")
    )
    return (
        resolve_company(houses, catalogue, aliases).where("error is not null")
        .select(F.col("name").alias("fund_house"), "candidates", "error")
        .orderBy("fund_house")
    )


def _keyed(names: DataFrame, aliases: DataFrame | None) -> DataFrame:
    keyed = names.select("name").distinct().withColumn("key", strip(F.col("name")))
    if aliases is not None:
        keyed = keyed.join(
            aliases.select(F.col("alias").alias("key"), F.col("name").alias("full_name")),
            "key", "left",
        ).withColumn("key", F.coalesce("full_name", "key"))
    return keyed.select("name", F.lower("key").alias("key"))


def _prefixes(listed: DataFrame, asked: DataFrame, *columns: str) -> DataFrame:
    """Prefixes of the catalogue's names in the lengths that the ``asked`` keys have; others meet no key.

    The names are dealt out first, as a catalogue is often a single split.
    """
    lengths = asked.select(F.length("key").alias("cut")).distinct()  # at most those of the longest key
    dealt = listed.repartition(int(listed.sparkSession.conf.get("spark.sql.shuffle.partitions")), "code")
    return dealt.join(F.broadcast(lengths), F.col("cut") <= F.length("lower_name")).select(
        "code", *columns, F.substring("lower_name", F.lit(1), F.col("cut")).alias("key"))
