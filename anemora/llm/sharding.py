"""Sharding by a hierarchical weighted hash tree: region, rack, shard."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anemora.llm.common import number_rows, unit_hash


@dataclass(frozen=True)
class Shard:
    number: int
    region: int
    rack: int
    weight: float = 1.0


@dataclass(frozen=True)
class Tree:
    """Shards with their place; a rack weighs what its shards weigh, a region what its racks weigh.

    A row descends by one weighted draw per child: ``-ln(u) / weight`` with ``u`` hashed from
    key and child, least draw first.  A child's draw depends on that child alone, so a changed
    weight moves rows only into or out of the subtrees that hold the change: the region, the
    rack in it and the shard in that.  ``with_shard`` opens a region of its own for the
    new shard; no other weight changes, so rows move into the new shard and nowhere else.
    """

    shards: tuple[Shard, ...]

    @staticmethod
    def even(shards: int, racks_per_region: int = 2, shards_per_rack: int = 4) -> Tree:
        size = racks_per_region * shards_per_rack
        return Tree(tuple(Shard(s, s // size, s % size // shards_per_rack) for s in range(shards)))

    def with_shard(self, weight: float = 1.0) -> Tree:
        last = max((s.number for s in self.shards), default=-1)
        region = max((s.region for s in self.shards), default=-1) + 1
        return Tree((*self.shards, Shard(last + 1, region, 0, weight)))

    def with_weight(self, number: int, weight: float) -> Tree:
        return Tree(tuple(replace(s, weight=weight) if s.number == number else s for s in self.shards))

    def levels(self) -> list[dict[str, list[tuple[str, float]]]]:
        """Children with weights of each node, level by level; names are paths, the last are shard numbers."""
        top: dict[str, float] = {}
        racks: dict[str, dict[str, float]] = {}
        leaves: dict[str, dict[str, float]] = {}
        for s in self.shards:
            if s.weight <= 0:
                continue
            region, rack, leaf = f"r{s.region}", f"r{s.region}.{s.rack}", str(s.number)
            top[region] = top.get(region, 0.0) + s.weight
            racks.setdefault(region, {})[rack] = racks.get(region, {}).get(rack, 0.0) + s.weight
            leaves.setdefault(rack, {})[leaf] = s.weight
        if not top:
            raise ValueError("a tree needs a shard of positive weight")
        return [{"": list(top.items())}, {k: list(v.items()) for k, v in racks.items()}, {k: list(v.items()) for k, v in leaves.items()}]


def place(tree: Tree, key: Column) -> Column:
    """The shard that ``key`` (a string) descends to; built-in functions alone."""
    node = F.lit("")
    for level in tree.levels():
        kids = {k: F.array(*[F.struct(F.lit(n).alias("name"), F.lit(float(w)).alias("weight")) for n, w in v]) for k, v in level.items()}
        choices = F.element_at(F.create_map(*[x for n, children in kids.items() for x in (F.lit(n), children)]), node)
        draws = F.transform(choices, lambda c: F.struct(
            (-F.log(unit_hash(key, c["name"]) + F.lit(2.0 ** -53)) / c["weight"]).alias("draw"), c["name"].alias("name")))
        node = F.array_min(draws)["name"]
    return node.cast("int")


def assign(df: DataFrame, tree: Tree, key: str = "doc_id", text: str = "text", grown: Tree | None = None) -> DataFrame:
    """Every row's ``size, text_crc32, shard, slot, grown_shard``, and the key.

    ``size`` is the text's UTF-8 bytes plus 8.  ``slot`` numbers a shard's rows from 0 without
    gaps.  ``grown_shard`` is the shard under the tree ``grown`` (default: one more shard).
    Null texts count no bytes and have the checksum of the empty text; null keys go to one
    shard; repeated rows share the shard and get slots of their own; no rows give no rows.
    Other columns are not carried along, so their names cannot clash.
    """
    grown = grown or tree.with_shard()
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    base = df.select(
        F.col(key).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).cast("long").alias("text_crc32"),
        name.alias("__name"),
    )
    placed = base.select("doc_id", "size", "text_crc32", place(tree, F.col("__name")).alias("shard"), place(grown, F.col("__name")).alias("grown_shard"))
    return number_rows(placed, ["shard"], ["doc_id", "size", "text_crc32"], "slot")


def shard_sql(tree: Tree, key: str) -> str:
    """The same descent as an SQL expression over the string expression ``key``."""
    def draw(name: str, weight: float) -> str:
        return f"(-ln(CAST(('0x' || substr(md5({key} || '|{name}'), 1, 13)) AS BIGINT) / {float(1 << 52)!r} + {2.0 ** -53!r}) / {weight!r})"

    def choose(children: list[tuple[str, float]], then) -> str:
        if len(children) == 1:
            return then(children[0][0])
        cases = []
        for i, (name, weight) in enumerate(children):
            others = ", ".join(draw(*other) for j, other in enumerate(children) if j != i)
            cases.append(f"WHEN {draw(name, weight)} <= least({others}) THEN {then(name)}")
        return f"CASE {' '.join(cases)} END"

    levels = tree.levels()
    return choose(levels[0][""], lambda r: choose(levels[1][r], lambda k: choose(levels[2][k], lambda s: s)))

