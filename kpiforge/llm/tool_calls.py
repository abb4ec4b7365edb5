"""Tool-call linking for chat training data. DataFrame functions only.

Calls and results are hash-joined by conversation and call identifier, calls
are put in an order in which each follows those whose results it uses, their
arguments are validated against the tools' schemas, and every call with its
result is serialised as canonical JSON (keys sorted, no white space, numbers
in shortest form, characters unescaped where JSON allows).

Order. A log's own turns are such an order unless a call uses the result of a
call of a later turn. So each call first takes the latest turn among itself
and all it depends on; this settles in as many rounds as there are calls out
of turn in a row, none for an orderly log. Calls of one settled turn that use
each other are then layered (Kahn), and calls on a cycle, or behind one, come
last in it, marked ``cyclic``. Positions count from 0 within a conversation;
they are found from a range-partitioned sort with one offset per partition, so
a conversation may be larger than a task.

Defined cases: a null or empty table gives an empty result; calls of a null
conversation or identifier are kept, match no result and have no position
relative to others (null conversations count as one); of several calls of one
identifier the first by turn, then by name and arguments, is the call and the
others are marked ``repeated`` (rows equal throughout are told apart by an
ordinal); of several results the first by turn, then by content, is linked; results without
a call come out as rows of kind ``orphan``. Null or unparsable arguments are
invalid. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiforge.llm.common import pick, shuffle_partitions
from kpiforge.session import cut_lineage, cut_lineage_counted

# JSON kinds a schema may ask for, and the beginnings of the types they parse to
TYPES = {"string": ["STRING"], "integer": ["BIGINT"], "number": ["BIGINT", "DECIMAL", "DOUBLE"],
         "boolean": ["BOOLEAN"], "array": ["ARRAY"], "object": ["OBJECT"]}

# tool -> parameter -> (type, required)
Schemas = dict[str, dict[str, tuple[str, bool]]]


def problems(name: Column, arguments: Column, schemas: Schemas) -> Column:
    """Sorted list of what is wrong with a call's arguments."""
    parsed = F.try_parse_json(arguments)
    none = F.array().cast("array<string>")
    out = F.array(F.concat(F.lit("unknown tool "), F.coalesce(name, F.lit("null"))))
    for tool, parameters in schemas.items():
        found = []
        for p, (kind, required) in parameters.items():
            got = F.schema_of_variant(F.try_variant_get(parsed, f"$['{p}']", "variant"))
            absent = F.lit(f"missing {p}") if required else F.lit(None).cast("string")
            right = F.lit(False)
            for begin in TYPES[kind]:
                right = right | got.startswith(begin)
            found.append(F.when(got.isNull(), absent).when(~right, F.lit(f"{p} is not of type {kind}")))
        extra = F.transform(F.array_except(F.json_object_keys(arguments), F.array(*[F.lit(p) for p in parameters])),
                            lambda k: F.concat(F.lit("unknown "), k))
        own = F.array_sort(F.concat(F.array_compact(F.array(*found)) if found else none, F.coalesce(extra, none)))
        out = F.when(name == tool, own).otherwise(out)
    shape = F.schema_of_variant(parsed)
    return (F.when(parsed.isNull(), F.array(F.lit("no JSON")))
            .when(~shape.startswith("OBJECT"), F.array(F.lit("no JSON object"))).otherwise(out))


def settle(calls: DataFrame, uses: DataFrame) -> DataFrame:
    """(conv, id, settled, layer, cyclic) of every call: ``calls`` (conv, id,
    turn), unique by conv and id; ``uses`` (conv, id, dep) between calls."""
    at = cut_lineage(calls.select("conv", "id", F.col("turn").alias("settled")))
    edges = cut_lineage(uses.select("conv", "id", "dep").distinct())
    both = ["conv", "id"]
    while True:  # the latest turn among a call and all that it depends on
        dep_at = at.select("conv", F.col("id").alias("dep"), F.col("settled").alias("later"))
        raised, n = cut_lineage_counted(
            edges.join(dep_at, ["conv", "dep"]).groupBy(both).agg(F.max("later").alias("later"))
            .join(at, both).filter(F.col("later") > F.col("settled")).select("conv", "id", "later"))
        if not n:
            break
        at = cut_lineage(at.join(raised, both, "left").select(
            *both, F.greatest("settled", F.coalesce("later", "settled")).alias("settled")))
    # calls that share a settled turn with one they use: layer by layer
    dep_at = at.select("conv", F.col("id").alias("dep"), F.col("settled").alias("later"))
    tied, n = cut_lineage_counted(edges.join(at, both).join(dep_at, ["conv", "dep"])
                                  .filter(F.col("later") == F.col("settled")).select("conv", "id", "dep"))
    placed, layer = None, 0
    while n:
        ready = tied.select("conv", F.col("dep").alias("id")).distinct() if layer == 0 else tied.select(both).distinct()
        waits = tied if placed is None else tied.join(
            placed.select("conv", F.col("id").alias("dep")), ["conv", "dep"], "left_anti")
        ready = ready.join(waits.select(both).distinct(), both, "left_anti")
        if placed is not None:
            ready = ready.join(placed.select(both), both, "left_anti")
        step, new = cut_lineage_counted(ready.withColumn("layer", F.lit(layer)))
        if not new and layer:
            break
        placed = step if placed is None else placed.unionByName(step)
        layer += 1
    if placed is None:
        return at.select("*", F.lit(0).alias("layer"), F.lit(False).alias("cyclic"))
    open_ = tied.select(both).distinct().join(placed.select(both), both, "left_anti").withColumn("cyclic", F.lit(True))
    return (at.join(placed, both, "left").join(open_, both, "left")
            .select(*both, "settled", F.when(F.col("cyclic"), layer).otherwise(F.coalesce("layer", F.lit(0)))
                    .alias("layer"), F.coalesce("cyclic", F.lit(False)).alias("cyclic")))


def numbered(df: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``df`` with the 0-based place of each row in its group by ``order``. Rows
    are range-partitioned by group and order, so a group may span partitions;
    one row per group and partition gives the offsets."""
    spark = df.sparkSession
    keys = [group, *order]
    sorted_ = (df.repartitionByRange(shuffle_partitions(spark), *keys).sortWithinPartitions(*keys)
               .withColumn("_at", F.monotonically_increasing_id()))
    stored = cut_lineage(sorted_).withColumn("_part", F.shiftright("_at", 33))
    parts = stored.groupBy(group, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    # as many rows of one group as there are partitions, at most
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offset = parts.select(F.col(group).alias("_g"), F.col("_part").alias("_p"), "_first",
                          F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    out = stored.join(offset, stored[group].eqNullSafe(offset["_g"]) & (stored["_part"] == offset["_p"]))
    return out.select(*[stored[c] for c in df.columns], (F.col("_at") - F.col("_first") + F.col("_offset")).alias(name))


def link(calls: DataFrame, results: DataFrame, schemas: Schemas) -> DataFrame:
    """One row per call and per orphan result.

    ``calls``: conv_id, call_id, turn, name, arguments (JSON text), uses (array
    of call ids whose results the call uses). ``results``: conv_id, call_id,
    turn, content.

    Returns kind (call, repeated, orphan), conv_id, call_id, turn, name,
    position (calls only), cyclic, problems, unknown_uses, result_turn,
    n_results and json."""
    c = pick(calls, conv="conv_id", id="call_id", turn="turn", name="name", arguments="arguments", uses="uses")
    r = pick(results, conv="conv_id", id="call_id", result_turn="turn", content="content")
    both = ["conv", "id"]
    # equal rows of one call are told apart by an ordinal; only they are shuffled by content
    whole = F.struct("turn", "name", "arguments", "uses")
    counted = c.groupBy("conv", "id", "turn", "name", "arguments", "uses").agg(F.count(F.lit(1)).alias("times"))
    first = c.groupBy(both).agg(F.min(whole).alias("first"), F.count(F.lit(1)).alias("n_calls"))
    one = cut_lineage(first.filter(F.col("conv").isNotNull() & F.col("id").isNotNull())
                      .select(*both, "first.*", "n_calls"))
    again = (counted.join(first.withColumnsRenamed({"conv": "_c", "id": "_i"}),
                          F.col("conv").eqNullSafe(F.col("_c")) & F.col("id").eqNullSafe(F.col("_i")))
             .filter((F.col("n_calls") > 1) | F.col("conv").isNull() | F.col("id").isNull())
             .withColumn("known", F.col("conv").isNotNull() & F.col("id").isNotNull())
             .withColumn("spare", F.col("times") - F.when(F.col("known") & whole.eqNullSafe(F.col("first")), 1)
                         .otherwise(0))
             .filter(F.col("spare") > 0)
             .select("conv", "id", "turn", "name", "arguments", "uses",
                     F.explode(F.sequence(F.lit(1), F.col("spare").cast("int"))).alias("_copy")))

    wanted = one.select("conv", "id", F.explode("uses").alias("dep")).distinct()
    known = wanted.join(one.select("conv", F.col("id").alias("dep")), ["conv", "dep"], "left_semi")
    unknown = (wanted.join(one.select("conv", F.col("id").alias("dep")), ["conv", "dep"], "left_anti")
               .groupBy(both).agg(F.array_sort(F.collect_set("dep")).alias("unknown_uses")))
    order = settle(one, known)
    placed = numbered(one.select(*both, "turn").join(order, both).select(*both, "settled", "layer", "turn", "cyclic"),
                      "conv", ["settled", "layer", "turn", "id"], "position")

    answer = r.groupBy(both).agg(F.min(F.struct("result_turn", "content")).alias("a"),
                                 F.count(F.lit(1)).alias("n_results"))
    linked = (one.join(placed.select(*both, "position", "cyclic"), both).join(answer, both, "left")
              .join(unknown, both, "left"))
    uses = F.coalesce("uses", F.array().cast("array<string>"))
    text = F.to_json(F.to_variant_object(F.struct(
        F.try_parse_json("arguments").alias("arguments"), F.col("a.content").alias("content"),
        F.col("id").alias("id"), F.col("name").alias("name"), F.col("position").alias("position"),
        uses.alias("uses"))))
    none = F.array().cast("array<string>")
    done = linked.select(
        F.lit("call").alias("kind"), F.col("conv").alias("conv_id"), F.col("id").alias("call_id"), "turn", "name",
        "position", "cyclic", problems(F.col("name"), F.col("arguments"), schemas).alias("problems"),
        F.coalesce("unknown_uses", none).alias("unknown_uses"), F.col("a.result_turn").alias("result_turn"),
        F.coalesce("n_results", F.lit(0)).cast("bigint").alias("n_results"), text.alias("json"))

    def rest(df: DataFrame, kind: str, **columns: Column) -> DataFrame:
        return df.select(*[columns.get(f.name, F.lit(kind) if f.name == "kind" else F.lit(None))
                           .cast(f.dataType).alias(f.name) for f in done.schema.fields])

    repeated = rest(again, "repeated", conv_id=F.col("conv"), call_id=F.col("id"), turn=F.col("turn"),
                    name=F.col("name"), problems=problems(F.col("name"), F.col("arguments"), schemas),
                    unknown_uses=none, cyclic=F.lit(False), n_results=F.lit(0),
                    json=F.to_json(F.try_parse_json("arguments")))
    lost = r.join(one.select(both), both, "left_anti")
    orphans = rest(lost, "orphan", conv_id=F.col("conv"), call_id=F.col("id"), result_turn=F.col("result_turn"),
                   problems=none, unknown_uses=none, cyclic=F.lit(False), n_results=F.lit(1),
                   json=F.to_json(F.to_variant_object(F.struct("content"))))
    return done.unionByName(repeated).unionByName(orphans)
