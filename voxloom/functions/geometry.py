"""Boxes, vectors and chunk grids as column expressions. Boxes are half open."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Triple = Sequence[Column | int]


def _col(x: Column | int) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def vec(x: Column | int, y: Column | int, z: Column | int) -> Column:
    """A vector; structs compare lexicographically."""
    return F.struct(_col(x).alias("x"), _col(y).alias("y"), _col(z).alias("z"))


def zip_vec(a: Column, b: Column, f) -> Column:
    """Component-wise f of two vectors: add, subtract, multiply, minimum and so on."""
    return vec(*(f(a[k], b[k]) for k in "xyz"))


def map_vec(a: Column, f) -> Column:
    """Component-wise f: negation, abs, bround (half-even), shifts."""
    return vec(*(f(a[k]) for k in "xyz"))


def minimum(a: Column, b: Column) -> Column:
    return zip_vec(a, b, F.least)


def maximum(a: Column, b: Column) -> Column:
    return zip_vec(a, b, F.greatest)


def floor_div(a: Column, b: Column | int) -> Column:
    """Division that rounds down, for negative numbers too."""
    return F.floor(a / b).cast("long")


def all_of(a: Column, b: Column, f) -> Column:
    """Whether f holds for all three components."""
    return f(a["x"], b["x"]) & f(a["y"], b["y"]) & f(a["z"], b["z"])


def box(low: Column, high: Column) -> Column:
    return F.struct(low.alias("min"), high.alias("max"))


def translate(b: Column, by: Column) -> Column:
    return box(zip_vec(b["min"], by, lambda p, q: p + q), zip_vec(b["max"], by, lambda p, q: p + q))


def scale(b: Column, by: Column) -> Column:
    return box(zip_vec(b["min"], by, lambda p, q: p * q), zip_vec(b["max"], by, lambda p, q: p * q))


def divide(b: Column, by: Column) -> Column:
    return box(zip_vec(b["min"], by, floor_div), zip_vec(b["max"], by, floor_div))


def scale2d(b: Column, by: int) -> Column:
    return scale(b, vec(by, by, 1))


def divide2d(b: Column, by: int) -> Column:
    return divide(b, vec(by, by, 1))


def shape(b: Column) -> Column:
    return zip_vec(b["max"], b["min"], lambda p, q: p - q)


def hull(a: Column, b: Column) -> Column:
    return box(minimum(a["min"], b["min"]), maximum(a["max"], b["max"]))


def intersect(a: Column, b: Column) -> Column:
    return box(maximum(a["min"], b["min"]), minimum(a["max"], b["max"]))


def contains(b: Column, p: Column) -> Column:
    return all_of(b["min"], p, lambda q, r: q <= r) & all_of(p, b["max"], lambda q, r: q < r)


def grow(b: Column, by: int) -> Column:
    return box(map_vec(b["min"], lambda p: p - by), map_vec(b["max"], lambda p: p + by))


def shrink(b: Column, by: int) -> Column:
    return grow(b, -by)


def centered_box(at: Column, size: Column) -> Column:
    low = zip_vec(at, size, lambda p, s: p - floor_div(s, 2))
    return box(low, zip_vec(low, size, lambda p, s: p + s))


def transpose(v: Column) -> Column:
    """The vector with its components in reverse order."""
    return vec(v["z"], v["y"], v["x"])


def _with(b: Column | int, k: str) -> Column:
    return b[k] if isinstance(b, Column) else F.lit(b)


def true_divide(a: Column, b: Column | int) -> Column:
    return vec(*((a[k] / _with(b, k)) for k in "xyz"))


def floor_divide(a: Column, b: Column | int) -> Column:
    return vec(*(floor_div(a[k], _with(b, k)) for k in "xyz"))


def modulo(a: Column, b: Column | int) -> Column:
    """Remainders with the divisor's sign, so that floor_divide(a, b) * b + modulo(a, b) is a."""
    return vec(*((a[k] - floor_div(a[k], _with(b, k)) * _with(b, k)) for k in "xyz"))


def power(a: Column, b: Column | int) -> Column:
    return vec(*(F.pow(a[k], _with(b, k)) for k in "xyz"))


def shift_left(a: Column, bits: int) -> Column:
    return map_vec(a, lambda v: F.shiftleft(v.cast("long"), bits))


def shift_right(a: Column, bits: int) -> Column:
    return map_vec(a, lambda v: F.shiftright(v.cast("long"), bits))


def bit_and(a: Column, b: Column | int) -> Column:
    return vec(*(a[k].bitwiseAND(_with(b, k)) for k in "xyz"))


def bit_or(a: Column, b: Column | int) -> Column:
    return vec(*(a[k].bitwiseOR(_with(b, k)) for k in "xyz"))


def bit_xor(a: Column, b: Column | int) -> Column:
    return vec(*(a[k].bitwiseXOR(_with(b, k)) for k in "xyz"))


def tuple_text(v: Column) -> Column:
    """x,y,z"""
    return F.concat_ws(",", *(v[k].cast("string") for k in "xyz"))


def parse_tuple(text: Column) -> Column:
    """The integers of a comma-separated text."""
    return F.transform(F.split(text, ","), lambda x: F.trim(x).cast("long"))


def max_face_shape(v: Column) -> Column:
    """The two greater components, in order."""
    return F.slice(F.array_sort(F.array(v["x"], v["y"], v["z"])), 2, 2)


def containing_box(at: Column, size: Column, volume: Column) -> Column:
    """A box of that size around a place, moved into [0, volume)."""
    return shift_to_bounds(centered_box(at, size), volume)


def bounds_1d(stop: Column | int, step: int, start: int = 0) -> Column:
    """Begins and ends of the steps from start to stop: ends lie at multiples of step, the last at stop."""
    first = start // step
    last = F.greatest(F.lit(first), floor_div(_col(stop) + (step - 1), step) - 1)
    low = lambda k: F.greatest(F.lit(start).cast("long"), k.cast("long") * step)
    return F.transform(F.sequence(F.lit(first).cast("long"), last.cast("long")), lambda k: F.struct(low(k).alias("begin"), F.least(_col(stop).cast("long"), k * step + step).alias("end")))


def closest_chunk_boundary(at: Column, offset: Column, chunk: Column) -> Column:
    """The chunk corner nearest to a place; halves go to the even corner."""
    return vec(*((F.bround((at[k] - offset[k]) / chunk[k]).cast("long") * chunk[k] + offset[k]) for k in "xyz"))


def num_faces(volume: Column, chunk: Column, mip: int = 0) -> Column:
    """Faces between chunks of a volume; mip halves x and y of both that often."""
    halve = {"x": 1 << mip, "y": 1 << mip, "z": 1}
    n = [F.greatest(F.lit(1).cast("long"), F.ceil(floor_div(volume[k], halve[k]) / floor_div(chunk[k], halve[k])).cast("long")) for k in "xyz"]
    return (n[0] - 1) * n[1] * n[2] + n[0] * (n[1] - 1) * n[2] + n[0] * n[1] * (n[2] - 1)


def shift_to_bounds(b: Column, volume: Column) -> Column:
    """b moved into [0, volume)."""
    by = vec(*(F.greatest(F.lit(0), -b["min"][k]) - F.greatest(F.lit(0), b["max"][k] - volume[k]) for k in "xyz"))
    return translate(b, by)


def expand_within(b: Column, size: Column, volume: Column) -> Column:
    """b grown to at least size, half of what is missing on each side, and moved into the volume."""
    less = zip_vec(size, shape(b), lambda s, t: F.greatest(F.lit(0), s - t))
    low = zip_vec(b["min"], less, lambda p, d: p - floor_div(d, 2))
    high = vec(*(b["max"][k] + less[k] - floor_div(less[k], 2) for k in "xyz"))
    return shift_to_bounds(box(low, high), volume)


def scaled_distance2(a: Sequence[Column], b: Sequence[Column], resolution: Sequence[int]) -> Column:
    """Squared distance in physical units."""
    parts = [((p - q) * r) * ((p - q) * r) for p, q, r in zip(a, b, resolution, strict=True)]
    return parts[0] + parts[1] + parts[2]


def chunk_grid(spark: SparkSession, volume: Sequence[int], chunk: Sequence[int], offset: Sequence[int] = (0, 0, 0), mip: int = 0) -> DataFrame:
    """All chunks of a volume, the last of an axis clipped: begin_*, end_*, chunk_tag. mip halves x and y that often."""
    halve = (1 << mip, 1 << mip, 1)
    size, off = [v // h for v, h in zip(volume, halve, strict=True)], [o // h for o, h in zip(offset, halve, strict=True)]
    out = spark.range(1)
    for a, n, c in zip("xyz", size, chunk, strict=True):
        out = out.withColumn(f"i{a}", F.explode(F.sequence(F.lit(0), F.lit(max(0, -(-n // c) - 1)))))
    for a, n, c, o in zip("xyz", size, chunk, off, strict=True):
        out = out.withColumn(f"begin_{a}", (F.col(f"i{a}") * c + o).cast("long")).withColumn(f"end_{a}", F.least(F.col(f"begin_{a}") + c, F.lit(n + o)).cast("long"))
    return out.withColumn("chunk_tag", chunk_tag([F.col(f"begin_{a}") for a in "xyz"], [F.col(f"end_{a}") for a in "xyz"])).drop("id", "ix", "iy", "iz")


def chunk_tag(begin: Triple, end: Triple) -> Column:
    return F.concat(F.concat_ws("_", *(_col(c).cast("string") for c in begin)), F.lit("-"), F.concat_ws("_", *(_col(c).cast("string") for c in end)))


def parse_chunk_tag(tag: Column) -> Column:
    """Box of a tag x_y_z-X_Y_Z; coordinates may be negative. Null if the tag has another form."""
    n = r"(-?\d+)"
    pattern = rf"^{n}_{n}_{n}-{n}_{n}_{n}$"
    v = [F.when(tag.rlike(pattern), F.regexp_extract(tag, pattern, k)).cast("long") for k in range(1, 7)]
    return box(vec(*v[:3]), vec(*v[3:]))


def face_tag(axis: Column, hi: Column) -> Column:
    return F.concat(F.lit("f"), axis.cast("string"), F.when(hi, F.lit("_hi")).otherwise(F.lit("_lo")))


def parse_face_tag(tag: Column) -> Column:
    return F.struct(F.regexp_extract(tag, r"f([0-2])_(hi|lo)", 1).cast("int").alias("axis"), (F.regexp_extract(tag, r"f([0-2])_(hi|lo)", 2) == "hi").alias("hi"))


def pcg_chunk_id(layer: Column, x: Column, y: Column, z: Column, bits: int) -> Column:
    """Packed id: layer in the top 8 bits, then x, y, z of bits each. Coordinates out of range are an error."""
    ok = (x >= 0) & (y >= 0) & (z >= 0) & (x < (1 << bits)) & (y < (1 << bits)) & (z < (1 << bits))
    packed = F.shiftleft(layer.cast("long"), 56).bitwiseOR(F.shiftleft(x.cast("long"), 56 - bits)).bitwiseOR(F.shiftleft(y.cast("long"), 56 - 2 * bits)).bitwiseOR(F.shiftleft(z.cast("long"), 56 - 3 * bits))
    return F.when(ok, packed).otherwise(F.raise_error(F.lit("chunk coordinate out of range")).cast("long"))


def pcg_unpack(packed: Column, bits: int) -> Column:
    """layer, x, y, z of a packed id."""
    field = lambda shift, n: F.shiftrightunsigned(packed, shift).bitwiseAND(F.lit((1 << n) - 1))
    return F.struct(field(56, 8).alias("layer"), field(56 - bits, bits).alias("x"), field(56 - 2 * bits, bits).alias("y"), field(56 - 3 * bits, bits).alias("z"))
