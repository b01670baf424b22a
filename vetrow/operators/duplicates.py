"""Rows that share a natural key.

Policy: among *valid* rows of one key, if they disagree on any fingerprint
column every one of them is a ``duplicate_key_conflict``; if they are all the
same observation, one copy (the smallest row id) is kept and the others are
``exact_duplicate``. Rejected rows neither cause nor receive a flag.

Scale form, no window over a key (a hot key could hold a third of the data):

1. ``valid.groupBy(key).count()`` - partial aggregation, so the shuffle carries
   only keys and a hot key collapses map-side. Keys seen more than once are
   written to the shared checkpoint folder (parquet, computed once) and
   counted. The usual answer is "none", and then nothing else runs.
2. A bitmap of the hashes of those keys, of at most ``MAX_BITS`` bits however many
   keys there are, parts the valid rows in their own tasks: those whose bit is not
   set hold a key of their own for certain and never travel. Only the contested
   ones, a few more than those that do share a key, go on.
3. Contested rows are aggregated again per key:
   ``min(struct) <=> max(struct)`` over the rest of the fingerprint says whether all
   copies agree (exact, no hash collisions), ``min(row id)`` names the copy kept.
4. The per-key verdicts are joined to the contested rows; all others pass by
   untouched. Spark broadcasts the written tables only by their real size;
   beyond its threshold the joins shuffle and AQE splits a skewed key.
5. Rows of a table that numbers them (``PLACE``) join the verdicts by key and place
   alone. What comes of it is two bits for each row, in pieces that are sent to the
   rows where they lie, so that no whole row is moved or written once more. Beyond
   ``MAX_PIECES`` pieces (64 MB), the contested rows are moved as in 4.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vetrow.operators.contract import REASONS_COL, is_valid
from vetrow.session import materialize, materialize_counted
from vetrow.spec import DUPLICATE_CONFLICT, EXACT_DUPLICATE, ContractSpec, SURVEY


BITS_PER_KEY = 16  # about one key in as many that is held once is taken for a repeated one, too
MAX_BITS = 1 << 28  # 32 MB, sent to every executor; with more keys than fit more rows are contested
PIECE = 1 << 15  # bits in one value of ``bitmap_construct_agg``
PLACE = "_place"  # column (long) that numbers the rows of a table, rising by one within a file
PLACES_SHIFT = 14  # two bits for each place: so many places (as a power of 2) fill a piece
MAX_PIECES = 1 << 14


class RowIdError(RuntimeError):
    """Two rows of one key carry the same row id, so no copy can be named as the one kept."""


def repeated_keys(contracted: DataFrame, spec: ContractSpec = SURVEY) -> DataFrame:
    """Natural keys held by more than one valid row."""
    counted = contracted.where(is_valid()).groupBy(*spec.natural_key).agg(F.count(F.lit(1)).alias("_key_rows"))
    return counted.where("_key_rows > 1").drop("_key_rows")


def _with_key(rows: DataFrame, spec: ContractSpec) -> DataFrame:
    """The rows that a key can be compared for: none of its columns is NULL."""
    return rows.dropna(subset=list(spec.natural_key))


def check_row_ids(rows: DataFrame, spec: ContractSpec = SURVEY, folder: str | None = None) -> None:
    """``RowIdError`` if two rows of one key have the same row id. Only a hash of both is moved; rows whose hash is held
    twice are looked at as they are."""
    ids = [*spec.natural_key, spec.row_id]
    rows = _with_key(rows, spec).select(*ids, F.xxhash64(*ids).alias("_hash"))
    hashes = rows.groupBy("_hash").agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1").select("_hash")
    twice, met = materialize_counted(hashes, "repeated-ids", folder)
    if not met:
        return
    clash = rows.join(twice, "_hash", "left_semi").groupBy(*ids).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1").limit(1).collect()
    if clash:
        raise RowIdError(f"{spec.row_id} {clash[0][spec.row_id]} and other ids stand for several rows of one key")


def key_verdicts(rows: DataFrame, spec: ContractSpec = SURVEY) -> DataFrame:
    """One row per repeated key of valid rows: conflict or not, the row id kept, and its place if the rows have one."""
    key = list(spec.natural_key)
    told = F.struct(*([c for c in spec.fingerprint if c not in key] or key))  # the key itself is the same in all of them
    keeper = F.min(F.when(F.col(spec.row_id).isNotNull(), F.struct(*(c for c in (spec.row_id, PLACE) if c in rows.columns))))
    by_key = _with_key(rows, spec).groupBy(*key).agg(
        F.count(F.lit(1)).alias("_rows"), F.min(told).alias("_low"), F.max(told).alias("_high"), keeper.alias("_kept"))
    place = [F.col(f"_kept.{PLACE}").alias("_kept_place")] if PLACE in rows.columns else []
    return by_key.where("_rows > 1").select(
        *key, (~F.col("_low").eqNullSafe(F.col("_high"))).alias("_conflict"), F.col(f"_kept.{spec.row_id}").alias("_keeper"), *place)


def _bit(key: Sequence[str], bits: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(bits))


def key_bitmap(keys: DataFrame, key: Sequence[str], bits: int) -> DataFrame:
    """(_piece, _bits): the bitmap in which the bits of the keys are set, in pieces; pieces without a set bit are left out."""
    bit = _bit(key, bits)
    pieces = keys.groupBy(F.floor(bit / PIECE).cast("long").alias("_piece"))
    return pieces.agg(F.bitmap_construct_agg(bit % PIECE).alias("_bits"))


def _byte(bit: Column) -> Column:
    """The byte of a piece that holds the bit."""
    return F.conv(F.hex(F.substring(F.col("_bits"), F.shiftright(bit, 3) + 1, F.lit(1))), 16, 10).cast("int")


def contested(rows: DataFrame, bitmap: DataFrame, key: Sequence[str], bits: int) -> tuple[DataFrame, DataFrame]:
    """The rows whose key has its bit set, and the others. The bitmap is bounded, so it is sent to the rows."""
    bit = _bit(key, bits)
    place = (bit % PIECE).cast("int")
    hit = (F.floor(bit / PIECE).cast("long") == F.col("_piece")) & (F.getbit(_byte(place), place.bitwiseAND(7)) == 1)
    sent = F.broadcast(bitmap)
    return rows.join(sent, hit, "left_semi"), rows.join(sent, hit, "left_anti")


def place_marks(rows: DataFrame, verdicts: DataFrame, spec: ContractSpec = SURVEY) -> DataFrame:
    """(_piece, _bits): two bits for each place of a table, the first set where the row's key is in conflict, the second
    where the row is a copy of the one kept; pieces without a set bit are left out."""
    key = list(spec.natural_key)
    named = rows.select(*key, PLACE, F.col(spec.row_id).isNotNull().alias("_named"))
    met = named.join(verdicts.select(*key, "_conflict", "_kept_place"), key)
    flagged = met.where(F.col("_conflict") | (F.col("_named") & (F.col(PLACE) != F.col("_kept_place"))))
    bit = F.col(PLACE) % (1 << PLACES_SHIFT) * 2 + F.when(F.col("_conflict"), F.lit(0)).otherwise(F.lit(1))
    dealt = flagged.select(F.shiftright(PLACE, PLACES_SHIFT).alias("_piece"), bit.alias("_bit")).repartition("_piece")
    return dealt.groupBy("_piece").agg(F.bitmap_construct_agg("_bit").alias("_bits"))


def flag_places(contracted: DataFrame, marks: DataFrame) -> DataFrame:
    """The duplicate flags of the marks in the reasons of the rows they stand for."""
    bit = (F.col(PLACE) % (1 << PLACES_SHIFT) * 2).cast("int")
    byte, at = _byte(bit), bit.bitwiseAND(7)
    flag = F.when(F.getbit(byte, at) == 1, F.array(F.lit(DUPLICATE_CONFLICT))).when(
        F.getbit(byte, at + 1) == 1, F.array(F.lit(EXACT_DUPLICATE)))
    met = contracted.join(F.broadcast(marks), F.shiftright(PLACE, PLACES_SHIFT) == F.col("_piece"), "left")
    return met.withColumn(REASONS_COL, F.coalesce(flag, F.col(REASONS_COL))).select(*contracted.columns)


def flag_duplicates(contracted: DataFrame, spec: ContractSpec = SURVEY, *, folder: str | None = None, placed_out: bool = False) -> DataFrame:
    """Adds the duplicate flags to the reasons. Raises ``RowIdError`` if the row id does not tell the copies apart.

    Rows of a table that has ``PLACE`` come out without it, unless ``placed_out``. They may be read more than once: no reader
    moves them to the verdicts again."""
    key = list(spec.natural_key)
    columns = [c for c in contracted.columns if c != PLACE or placed_out]
    keys, repeated = materialize_counted(repeated_keys(contracted, spec), "repeated-keys", folder)
    if not repeated:
        return contracted.select(*columns)
    bits = min(MAX_BITS, max(PIECE, 1 << (BITS_PER_KEY * repeated - 1).bit_length()))
    bitmap = materialize(key_bitmap(keys, key, bits), "key-bitmap", folder)
    shared, alone = contested(contracted.where(is_valid()), bitmap, key, bits)
    check_row_ids(shared, spec, folder)
    verdicts = materialize(key_verdicts(shared, spec), "key-verdicts", folder)
    placed = PLACE in contracted.columns
    if placed:
        marks, pieces = materialize_counted(place_marks(shared, verdicts, spec), "place-marks", folder)
        if pieces <= MAX_PIECES:
            return flag_places(contracted, marks).select(*columns)
    valid = shared.join(verdicts, key, "left")
    flag = F.when(F.col("_conflict"), F.array(F.lit(DUPLICATE_CONFLICT))).when(
        F.col(spec.row_id) != F.col("_keeper"), F.array(F.lit(EXACT_DUPLICATE)))
    flagged = valid.withColumn(REASONS_COL, F.coalesce(flag, F.col(REASONS_COL))).select(*contracted.columns)
    if placed:
        flagged = materialize(flagged, "flagged", folder)
    return flagged.unionByName(alone).unionByName(contracted.where(~is_valid())).select(*columns)


#: Row id of the published row that a rejected one repeats or contradicts.
OTHER_ROW = "_other_row"


def published_twins(evaluated: DataFrame, published: DataFrame, own_slice: Column, spec: ContractSpec = SURVEY, *,
                    partition: str = "collection_year", folder: str | None = None) -> DataFrame:
    """(row id, ``_other_row``, ``_same``): the valid rows whose key a published row of another slice holds, one row each, with
    their place if the rows have one.

    Keys are unique on both sides: among valid rows once duplicates are flagged, and in the published table. Only its
    partitions (years of the date in the key) that the slice has rows of are read, and of them the key, the compared
    columns and the row id."""
    key = list(spec.natural_key)
    day = next(f.name for f in spec.fields if f.read_as == "date")
    told = F.struct(*(F.col(c).alias(c) for c in ([c for c in spec.fingerprint if c not in key] or key)))  # the key is the same in both
    place = [c for c in (PLACE,) if c in evaluated.columns]
    valid = evaluated.where(is_valid())
    years = [r[0] for r in valid.select(F.year(day)).distinct().collect()]  # as many as the calendar has
    others = published.where(F.col(partition).isin(years) & ~F.coalesce(own_slice, F.lit(False)))
    theirs = others.select(*key, F.col(spec.row_id).alias(OTHER_ROW), told.alias("_theirs"))
    ours = valid.select(*key, spec.row_id, *place, told.alias("_ours"))
    twins = ours.join(theirs, key).select(spec.row_id, *place, OTHER_ROW, F.col("_ours").eqNullSafe(F.col("_theirs")).alias("_same"))
    return materialize(twins, "published-twins", folder)


def part_published(evaluated: DataFrame, published: DataFrame, own_slice: Column, spec: ContractSpec = SURVEY, *,
                   partition: str = "collection_year", folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows that repeat or contradict no row which another slice published, as they are, and the others, flagged, with
    ``_other_row``. Both come without ``PLACE``; of rows that have it only the others are moved, as a bit for each place, sent
    to where the rows lie, tells them apart."""
    twins = published_twins(evaluated, published, own_slice, spec, partition=partition, folder=folder)
    reason = F.when(F.col("_same"), F.lit(EXACT_DUPLICATE)).otherwise(F.lit(DUPLICATE_CONFLICT))
    columns = [c for c in evaluated.columns if c != PLACE]
    on, rest, met = spec.row_id, None, None
    if PLACE in evaluated.columns:
        on, twins = PLACE, twins.where(F.col(spec.row_id).isNotNull() & F.col(OTHER_ROW).isNotNull()).drop(spec.row_id)
        bit = F.col(PLACE) % (1 << PLACES_SHIFT)
        dealt = twins.select(F.shiftright(PLACE, PLACES_SHIFT).alias("_piece"), bit.alias("_bit"))
        marks, pieces = materialize_counted(
            dealt.repartition("_piece").groupBy("_piece").agg(F.bitmap_construct_agg("_bit").alias("_bits")), "published-marks", folder)
        if pieces <= MAX_PIECES:
            at = bit.cast("int")
            hit = (F.shiftright(PLACE, PLACES_SHIFT) == F.col("_piece")) & (F.getbit(_byte(at), at.bitwiseAND(7)) == 1)
            rest, met = (evaluated.join(F.broadcast(marks), hit, how) for how in ("left_anti", "left_semi"))
    if rest is None:
        judged = evaluated.join(twins, on, "left")
        rest, met = judged.where(F.col(OTHER_ROW).isNull()), judged.where(F.col(OTHER_ROW).isNotNull())
    else:
        met = met.join(twins, on)
    return rest.select(*columns), met.withColumn(REASONS_COL, F.array(reason)).select(*columns, OTHER_ROW)


def flag_published(evaluated: DataFrame, published: DataFrame, own_slice: Column, spec: ContractSpec = SURVEY, *,
                   partition: str = "collection_year", folder: str | None = None) -> DataFrame:
    """Valid rows that repeat a row which another slice published are exact duplicates, those that contradict one are
    conflicts; ``_other_row`` names it. Rejected rows stay as they are, and so does what is published."""
    rest, met = part_published(evaluated, published, own_slice, spec, partition=partition, folder=folder)
    return rest.withColumn(OTHER_ROW, F.lit(None).cast(met.schema[OTHER_ROW].dataType)).unionByName(met)
