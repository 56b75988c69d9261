"""Sparse products, local to one of the two keys.

Pairs of raters of an item are as many as its raters squared, so they are never
shuffled as rows. The raters of an item are one list, or, if the item is hot,
lists of about ``BLOCK_ROWS`` (every two lists meet). Each rater is sent, with the
list of those it meets, to the partition of its own id, where the pairs come out
of the lists and are summed at once: what is shuffled is an id and a value a
product. Partitions are as many as the counted products ask for, and the products
of a hot key are dealt over several by a hash of the other one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from nearrate.keep import keep

BLOCK_ROWS = 2048
#: About so many products are in a partition, and of one key in one partition.
TASK_PAIRS, KEY_PAIRS = 1 << 20, 1 << 22
#: Few of those a user meets are one of so many at most.
NEAR_OF_MET = 16
#: Steps of a value that is sent as a byte, and room for the rounding of sums.
STEPS, SLACK = 127, 1e-6


def own_exchange(df: DataFrame, column: str) -> DataFrame:
    """``df``, aggregated by a long column, laid out anew for a join on it: with
    an exchange directly below both sides, adaptive execution splits a hot key."""
    return df.withColumn(column, F.col(column).bitwiseXOR(F.lit(0).cast("long")))


def with_blocks(df: DataFrame, inner: str, group: tuple[str, ...] = (), block_rows: int | None = None) -> DataFrame:
    """Add ``n_blocks``, the number of blocks of the row's ``inner`` key."""
    size = F.ceil(F.count(F.lit(1)) / (block_rows or BLOCK_ROWS)).cast("int")
    sizes = df.groupBy(*group, inner).agg(size.alias("n_blocks"))
    return df.join(own_exchange(sizes, inner), [*group, inner])


def _block(key: str):
    return F.pmod(F.xxhash64(key), F.col("n_blocks")).cast("int")


def in_chunks(df: DataFrame, key: str, member: str, element, rows: int) -> DataFrame:
    """(key, chunk, elements): each key's elements, in arrays of about ``rows``
    (dealt by a hash of ``member``), sorted within a chunk; none is left out and
    a hot key is spread over as many rows as it needs."""
    dealt = with_blocks(df, key, block_rows=rows).withColumn("chunk", _block(member))
    return dealt.groupBy(key, "chunk").agg(F.sort_array(F.collect_list(element)).alias("elements"))


def _sizes(df: DataFrame, key: str, inner: str, group: tuple[str, ...]) -> dict:
    """Rows of each inner; of all, their squares' sum, the most, and the most of a key."""
    n = F.col("n")
    of_inner = df.groupBy(*group, inner).agg(F.count(F.lit(1)).alias("n"))
    products, most = of_inner.agg(F.sum(n * n), F.max("n")).first()
    items, low, high = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n"), F.min(key), F.max(key)).first()
    return {"of_inner": of_inner, "products": products or 0, "most": most or 0, "items": items or 0, "low": low or 0, "high": high or 0}


def _short(sizes: dict):
    """Two functions, that make ids shorter and restore them: half as long as their
    distance from the smallest one, where all of these fit."""
    low = sizes["low"]
    if sizes["high"] - low >= 1 << 31:
        return (lambda i: i), (lambda i: i)
    return (lambda i: (i - F.lit(low)).cast("int")), (lambda i: i.cast("long") + F.lit(low))


def _meetings(df: DataFrame, key: str, inner: str, columns: list[str], most: int, group: tuple[str, ...] = (), block_rows: int | None = None) -> DataFrame:
    """(group..., inner, a, members): every row of ``df`` as a struct ``a`` (id,
    columns...) with a list of the rows of its ``inner``, itself among them; of a
    hot one with each of its lists. If none is hot (``most`` rows), no list is moved."""
    if most <= (block_rows or BLOCK_ROWS):
        members = F.sort_array(F.collect_list(F.struct(F.col(key).alias("id"), *columns))).alias("members")
        return df.groupBy(*group, inner).agg(members).select(*group, inner, F.explode("members").alias("a"), "members")
    rows = with_blocks(df.select(*group, inner, key, *columns), inner, group, block_rows).withColumn("own", _block(key))
    lists = (rows.groupBy(*group, inner, "n_blocks", "own")
             .agg(F.sort_array(F.collect_list(F.struct(F.col(key).alias("id"), *columns))).alias("members")))
    each = F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))
    mine = lists.select(*group, inner, F.col("own").alias("rb"), each.alias("cb"), F.col("members").alias("mine"))
    theirs = lists.select(*group, inner, each.alias("rb"), F.col("own").alias("cb"), "members")
    return mine.join(theirs, [*group, inner, "rb", "cb"]).select(*group, inner, F.explode("mine").alias("a"), "members")


def _dealt(sent: DataFrame, df: DataFrame, sizes: dict, key: str, inner: str, group: tuple[str, ...] = ()):
    """Rows (user_id, others, ...), ``others`` an array of structs with ``id``: with
    the column ``part``, over which the others of a hot user are dealt, and the
    function that lays them out by user_id and part."""
    parts = max(1, -(-sizes["products"] // TASK_PAIRS))
    sent = sent.withColumn("part", F.lit(0))
    if sizes["items"] * sizes["most"] > KEY_PAIRS:  # some key may be hot: one row for each that is
        met = df.select(*group, inner, key).join(sizes["of_inner"], [*group, inner]).groupBy(F.col(key).alias("user_id")).agg(F.sum("n").alias("met"))
        hot = met.where(F.col("met") > KEY_PAIRS).select("user_id", F.ceil(F.col("met") / KEY_PAIRS).cast("int").alias("n_parts"))
        sent = sent.join(F.broadcast(hot), "user_id", "left").withColumn("n_parts", F.coalesce("n_parts", F.lit(1)))
        sent = sent.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("n_parts") - 1)))
        mine = F.filter("others", lambda o: F.pmod(F.xxhash64(o["id"]), F.col("n_parts")) == F.col("part"))
        sent = sent.withColumn("others", F.when(F.col("n_parts") == 1, F.col("others")).otherwise(mine)).drop("n_parts")
        return sent, lambda packed: packed.repartition(parts, "user_id", "part")
    return sent, lambda packed: packed.repartition(parts, "user_id")


def pair_sums(df: DataFrame, key: str, inner: str, value: str, carry: str | None = None,
              group: tuple[str, ...] = (), block_rows: int | None = None, apart: str | None = None, both: bool = False) -> DataFrame:
    """(group..., user_id, other_id, value): for each unordered pair of keys that
    share an ``inner`` (within a group), the sum of the products of their values,
    user_id < other_id; with ``both`` in both directions. Rows lie by user_id.
    ``carry`` is a column that depends on the key alone; it comes back as
    ``<carry>_u`` and ``<carry>_v``. (key, inner) must be unique. Two rows for
    which the boolean column ``apart`` holds never meet."""
    extra = [carry] if carry else []
    marks = [apart] if apart else []
    sizes = _sizes(df, key, inner, group)
    met = _meetings(df, key, inner, [value, *extra, *marks], sizes["most"], group, block_rows)
    a = F.col("a")

    def meets(o):
        other = o["id"] != a["id"] if both else o["id"] > a["id"]
        return other & ~(o[apart] & a[apart]) if apart else other

    sent = met.select(*group, a["id"].alias("user_id"), a[value].alias("x"), *[a[c].alias(f"{c}_u") for c in extra], F.filter("members", meets).alias("others"))
    sent, dealt = _dealt(sent, df, sizes, key, inner, group)
    # arrays of one kind each: far smaller when shuffled than an array of structs
    kinds = {"other_id": "id", "y": value, **{f"{c}_v": c for c in extra}}
    short, whole = _short(sizes)
    packed = dealt(sent.select(*group, "user_id", "part", "x", *[f"{c}_u" for c in extra], F.transform("others", lambda o: short(o["id"])).alias("other_id"),
                               *[F.col("others")[c].alias(n) for n, c in kinds.items() if n != "other_id"]))
    pairs = packed.select(*group, "user_id", "part", "x", *[f"{c}_u" for c in extra], F.inline(F.arrays_zip(*kinds)))
    sums = [F.sum(F.col("x") * F.col("y")).alias(value), *[F.first(f"{c}_{m}").alias(f"{c}_{m}") for c in extra for m in "uv"]]
    return pairs.groupBy(*group, "user_id", "part", "other_id").agg(*sums).drop("part").withColumn("other_id", whole(F.col("other_id")))


def near_pairs(df: DataFrame, key: str, inner: str, value: str, k: int, block_rows: int | None = None) -> DataFrame:
    """(user_id, other_id, value): of ``pair_sums`` in both directions, for each key its
    k largest sums that are positive, with all ties and a few others; exact, and laid
    out by user_id. ``value`` is at most 1 in size, (key, inner) unique, both long.

    A product takes an id and one byte: the other's value in steps of 1 / STEPS, which
    bounds a sum from both sides. A pair whose upper bound is below the k-th largest
    lower bound of its user goes; only the values of the pairs left are fetched whole."""
    sizes = _sizes(df, key, inner, ())
    short, whole = _short(sizes)
    a = F.col("a")
    met = _meetings(df, key, inner, [value], sizes["most"], (), block_rows)
    sent = met.select(inner, a["id"].alias("user_id"), a[value].alias("x"), F.filter("members", lambda o: o["id"] != a["id"]).alias("others"))
    sent, dealt = _dealt(sent, df, sizes, key, inner)
    packed = dealt(sent.select("user_id", "part", F.col(inner).alias("met_on"), "x", F.transform("others", lambda o: short(o["id"])).alias("ids"),
                               F.transform("others", lambda o: F.round(o[value] * STEPS).cast("tinyint")).alias("steps")))
    found = packed.sortWithinPartitions("user_id", "part").mapInArrow(_open_pairs(k), "user_id long, met_on long, x double, other_id long")
    found = found.withColumnRenamed("met_on", inner).withColumn("other_id", whole(F.col("other_id")))
    theirs = df.select(F.col(key).alias("other_id"), inner, F.col(value).alias("y"))
    exact = found.join(theirs, ["other_id", inner]).select("user_id", "other_id", (F.col("x") * F.col("y")).alias("xy")).repartition("user_id")
    return exact.groupBy("user_id", "other_id").agg(F.sum("xy").alias(value))


def _open_pairs(k: int):
    """For ``near_pairs``, on rows sorted by (user_id, part): the products of the pairs
    that can be among the k largest; groups of rows of about TASK_PAIRS products at a time."""
    pairs_at_once, steps, slack = TASK_PAIRS, STEPS, SLACK

    def opened(t):
        import numpy as np
        import pyarrow as pa
        user, part, x = (t.column(c).to_numpy() for c in ("user_id", "part", "x"))
        lists = t.column("ids").combine_chunks()
        n = lists.value_lengths().to_numpy()
        ids, y = lists.flatten().to_numpy(), t.column("steps").combine_chunks().flatten().to_numpy()
        row = np.repeat(np.arange(len(n)), n)
        names, other = np.unique(ids, return_inverse=True)
        group = np.concatenate(([0], np.cumsum((user[1:] != user[:-1]) | (part[1:] != part[:-1]))))
        pair = group[row] * max(1, len(names)) + other
        order = np.argsort(pair, kind="stable")
        pair = pair[order]
        new = np.concatenate((np.ones(min(1, len(pair)), bool), pair[1:] != pair[:-1]))
        first = np.flatnonzero(new)
        if not len(first):
            return
        mine = x[row[order]]
        about = np.add.reduceat(mine * y[order], first)
        room = np.add.reduceat(np.abs(mine), first) * (0.5 + slack) + slack * steps
        low, top, of = about - room, about + room, pair[first] // max(1, len(names))
        down = np.lexsort((-low, of))
        begin = np.searchsorted(of, np.arange(group[-1] + 2))  # pairs are sorted by group
        kth = begin[:-1] + k - 1
        least = np.where(kth < begin[1:], low[down[np.minimum(kth, len(down) - 1)]], 0.0)
        stays = (top > 0) & (top >= least[of])
        at = order[np.repeat(stays, np.diff(np.append(first, len(pair))))]
        row = row[at]
        yield pa.RecordBatch.from_arrays([pa.array(user[row]), pa.array(t.column("met_on").to_numpy()[row]), pa.array(x[row]), pa.array(ids[at].astype(np.int64))],
                                         names=["user_id", "met_on", "x", "other_id"])

    def task(batches):
        import numpy as np
        import pyarrow as pa
        held, size = [], 0
        for b in batches:
            held.append(b)
            size += len(b.column("ids").flatten())
            if size < pairs_at_once:
                continue
            t = pa.Table.from_batches(held)
            user, part = t.column("user_id").to_numpy(), t.column("part").to_numpy()
            whole = int(np.argmax((user == user[-1]) & (part == part[-1])))  # the last group may go on
            if whole:
                yield from opened(t.slice(0, whole))
            held = t.slice(whole).combine_chunks().to_batches()
            size = sum(len(b.column("ids").flatten()) for b in held)
        if held:
            yield from opened(pa.Table.from_batches(held))

    return task


def asked_products(df: DataFrame, asked: DataFrame, inner: str, columns: list[str], sims: dict) -> DataFrame:
    """(user_id, inner, fact, a column for each of ``sims``): each requested (user_id,
    inner) of ``asked`` with the ``fact`` of every other user of that inner in ``df``
    (user_id, inner, fact, columns...) and the similarities of the two, where one
    is not 0. Each is made from the aggregates over the inners that both have of a
    user's ``columns`` (``u``) and the other's (``v``). A pair lies with its smaller
    id, so that each product is shuffled once, for all of ``sims`` together, and
    requests travel there as lists too."""
    values = ["fact", *columns]
    raters = df.select(inner, "user_id", *values, F.lit(False).alias("asks"))
    askers = asked.select(inner, "user_id").distinct().select(inner, "user_id", *[F.lit(None).cast(df.schema[c].dataType).alias(c) for c in values], F.lit(True).alias("asks"))
    rows = keep(raters.unionByName(askers))
    a = F.col("a")
    sizes = _sizes(rows, "user_id", inner, ())
    short, whole = _short(sizes)
    met = _meetings(rows, "user_id", inner, [*values, "asks"], sizes["most"])
    sent = met.select(inner, a["id"].alias("user_id"), *[a[c].alias(c) for c in [*values, "asks"]],
                      F.filter("members", lambda o: (o["id"] > a["id"]) & ~(o["asks"] & a["asks"])).alias("others"))
    sent, dealt = _dealt(sent, rows, sizes, "user_id", inner)
    mine = [inner, "user_id", "part", *values, "asks"]
    sent = sent.select(*mine, F.filter("others", lambda o: ~o["asks"]).alias("theirs"), F.filter("others", lambda o: o["asks"]).alias("askers"))
    # who asks gets the facts of the others, a rater their columns
    given = {c: F.when(F.col("asks") == F.lit(c == "fact"), F.col("theirs")[c]) for c in values}
    packed = dealt(sent.select(*mine, F.transform("theirs", lambda o: short(o["id"])).alias("ids"), F.transform("askers", lambda o: short(o["id"])).alias("askers"),
                               *[c.alias(f"{n}s") for n, c in given.items()]))
    # of each pair: its products, and its requests with who asks
    kinds = {c: F.lit(None).cast(df.schema[c].dataType) for c in values}
    of_other = F.transform(F.sequence(F.lit(0), F.size("ids") - 1), lambda i: F.struct(
        F.get("ids", i).alias("other_id"), *[F.get(f"{c}s", i).alias(f"{c}_v") for c in columns],
        F.when(F.col("asks"), F.col("user_id")).alias("asker"), F.get("facts", i).alias("fact_v")))
    one = F.when(F.size("ids") > 0, of_other).otherwise(F.slice(of_other, 1, 0))
    two = F.transform("askers", lambda o: F.struct(o.alias("other_id"), *[kinds[c].alias(f"{c}_v") for c in columns], whole(o).alias("asker"), F.col("fact").alias("fact_v")))
    pairs = packed.select(inner, "user_id", "part", "asks", *columns, F.inline(F.concat(one, two)))
    product = F.col("asker").isNull()
    pairs = pairs.select(inner, "user_id", "part", "other_id", "asker", "fact_v", *[F.when(product, F.col(c)).alias(c) for c in columns], *[f"{c}_v" for c in columns])
    shared = Window.partitionBy("user_id", "part", "other_id")
    u, v = {c: F.col(c) for c in columns}, {c: F.col(f"{c}_v") for c in columns}
    made = pairs.select("*", *[sim(u, v, shared).alias(f"sim_{n}") for n, sim in sims.items()])
    some = F.lit(False)
    for n in sims:
        some = some | (F.coalesce(f"sim_{n}", F.lit(0.0)) != 0)
    return made.where(~product & some).select(F.col("asker").alias("user_id"), inner, F.col("fact_v").alias("fact"), *[F.col(f"sim_{n}").alias(n) for n in sims])


def asked_members(df: DataFrame, asked: DataFrame, near: DataFrame, value: str, more: list[str], block_rows: int | None = None,
                  key_pairs: int | None = None, per_user: int | None = None) -> DataFrame:
    """(user_id, item_id, value, more...): each requested (user_id, item_id) of
    ``asked``, distinct, with those rows of ``df`` (user_id, item_id, value) of its item
    whose user is one of the few of the request's user in ``near`` (user_id,
    other_id, more...), where each stands once.

    A request takes the list of its item's raters (of a hot item, each of its lists) to
    its user, where those of ``near`` are looked up in it: what is shuffled is an id and
    a value a rater, and ``near`` stays where it lies by user_id. If a user has at most ``per_user`` in
    ``near``, few of those it meets, only ids are moved, and the values are
    joined to the raters that are found. The requests of a hot user are dealt over several places by a hash of the item, ``near`` goes to each."""
    counts = df.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
    most, products = counts.agg(F.max("n"), F.sum(F.col("n") * F.col("n"))).first()
    low, high, users = df.agg(F.min("user_id"), F.max("user_id"), F.approx_count_distinct("user_id")).first()
    bare = per_user is not None and per_user * NEAR_OF_MET * users <= (products or 0)
    most_asked = asked.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    most, key_pairs = most or 0, key_pairs or KEY_PAIRS
    short, whole = _short({"low": low or 0, "high": high or 0})
    rater = short(F.col("user_id"))
    members = F.sort_array(F.collect_list(F.struct(rater.alias("id"), *([] if bare else [F.col(value)])))).alias("members")
    if most <= (block_rows or BLOCK_ROWS):
        met = asked.select("user_id", "item_id").join(df.groupBy("item_id").agg(members), "item_id")
    else:
        dealt = with_blocks(df, "item_id", block_rows=block_rows).withColumn("blk", _block("user_id"))
        sizes = own_exchange(counts.select("item_id", F.ceil(F.col("n") / (block_rows or BLOCK_ROWS)).cast("int").alias("n_blocks")), "item_id")
        every = asked.select("user_id", "item_id").join(sizes, "item_id").select("user_id", "item_id", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("blk"))
        met = every.join(dealt.groupBy("item_id", "blk").agg(members), ["item_id", "blk"])
    met = met.select("user_id", "item_id", F.col("members.id").alias("ids"), *([] if bare else [F.col(f"members.{value}").alias("values")]))
    near = near.where(F.col("other_id").between(low or 0, high or 0))  # no one else rates
    few = near.groupBy("user_id").agg(F.collect_list(F.struct(short(F.col("other_id")).alias("id"), *more)).alias("few"))
    on = ["user_id"]
    if most * most_asked > key_pairs:  # some user may be hot: one row for each that is
        load = asked.join(own_exchange(counts, "item_id"), "item_id").groupBy("user_id").agg(F.sum("n").alias("met"))
        hot = keep(load.where(F.col("met") > key_pairs).select("user_id", F.ceil(F.col("met") / key_pairs).cast("int").alias("n_parts")))
        met, few = [t.join(F.broadcast(hot), "user_id", "left").withColumn("n_parts", F.coalesce("n_parts", F.lit(1))) for t in (met, few)]
        met = met.withColumn("part", F.pmod(F.xxhash64("item_id"), F.col("n_parts")).cast("int")).drop("n_parts")
        few = few.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("n_parts") - 1))).drop("n_parts")
        on = ["user_id", "part"]
    both = F.array_intersect("ids", F.col("few.id"))
    found = met.join(few, on).withColumn("id", F.explode(both))

    def of_id(c, ids):
        return F.get(c, (F.array_position(ids, F.col("id")) - 1).cast("int"))

    found = found.withColumn("one", of_id("few", F.col("few.id")))
    if bare:
        found = found.select("user_id", "item_id", whole(F.col("id")).alias("other_id"), "one")
        found = found.join(df.select(F.col("user_id").alias("other_id"), "item_id", value), ["other_id", "item_id"])
    else:
        found = found.withColumn(value, of_id("values", F.col("ids")))
    return found.select("user_id", "item_id", value, *[F.col("one")[c].alias(c) for c in more])


def asked_pair_sums(df: DataFrame, pairs: DataFrame, key: str, inner: str, value: str, carry: str | None = None) -> DataFrame:
    """``pair_sums`` of the requested pairs alone. ``pairs`` (user_id, other_id)
    have user_id < other_id and may repeat. Each is met with the rows of its first
    key (a hot key's in blocks), and these with those of its second: as many rows
    as the requested keys have, and no product of other pairs."""
    extra = [carry] if carry else []
    mine = df.select(F.col(key).alias("user_id"), inner, F.col(value).alias("x"), *[F.col(c).alias(f"{c}_u") for c in extra])
    theirs = df.select(F.col(key).alias("other_id"), inner, F.col(value).alias("y"), *[F.col(c).alias(f"{c}_v") for c in extra])
    met = blocked_join(pairs.select("user_id", "other_id").distinct(), mine, "user_id", inner).join(theirs, ["other_id", inner])
    carried = [F.first(f"{c}_{m}").alias(f"{c}_{m}") for c in extra for m in "uv"]
    return met.groupBy("user_id", "other_id").agg(F.sum(F.col("x") * F.col("y")).alias(value), *carried)


def blocked_join(left: DataFrame, right: DataFrame, inner: str, spread: str, block_rows: int | None = None, group: tuple[str, ...] = ()) -> DataFrame:
    """Inner join on ``inner`` (and ``group``). The rows of a key that is hot on the right are
    dealt over blocks by the column ``spread``, and its left rows go to each."""
    sizes = own_exchange(right.groupBy(*group, inner).agg(F.ceil(F.count(F.lit(1)) / (block_rows or BLOCK_ROWS)).cast("int").alias("n_blocks")), inner)
    dealt = right.join(sizes, [*group, inner]).withColumn("blk", _block(spread)).drop("n_blocks")
    every = (left.join(sizes, [*group, inner])
             .withColumn("blk", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))).drop("n_blocks"))
    return every.join(dealt, [*group, inner, "blk"]).drop("blk")
