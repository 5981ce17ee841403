"""Email uniqueness over a log: which user messages lose a contested address.

The rule is sequential. A message claims an address; it is refused while another user holds it, and
an accepted message with a new address frees the old one. A claim on an address therefore hangs on

* the last claim on the address before it that was not refused, and
* whether the user of that one has moved to a different address since.

Addresses claimed by one user only cannot conflict and are settled without any iteration. For the rest, each round
finds for every open claim these two with ordered scans. Some claims are settled by them at once. Others turn out to have
the outcome of one earlier open claim, whichever it is: they point to it, and pointers are doubled until they reach a
claim that points no further. So chains of users who hand addresses on end in a few rounds and as many doublings as the
logarithm of their length. Refused claims are dropped, and so is whatever no open claim can hang on any more. The earliest
open claim is settled in every round, so the rounds end.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.ordered import ROWS_PER_SLICE, in_slices, scan
from tidemark.session import staged


def contested_addresses(claims: DataFrame, holders: DataFrame) -> DataFrame:
    """Addresses that more than one user claims or holds."""
    wanted = claims.select("email").distinct()
    held = holders.join(wanted, "email", "left_semi").select("email", "user_id")
    return (
        claims.select("email", "user_id")
        .unionByName(held)
        .groupBy("email")
        .agg(F.min("user_id").alias("_low"), F.max("user_id").alias("_high"))
        .filter("_low <> _high")
        .select("email")
    )


def _contest(claims: DataFrame, holders: DataFrame, contested: DataFrame) -> DataFrame:
    """All messages that can influence a contested address, in one table.

    ``gen`` 0 marks rows already stored, 1 marks messages; ``sure`` rows are accepted whatever happens.
    """
    held = holders.join(contested, "email", "left_semi").select(
        F.lit(0).alias("gen"),
        F.lit(None).cast(claims.schema["seq"].dataType).alias("seq"),
        "user_id",
        "email",
        F.lit(True).alias("sure"),
    )
    involved = claims.join(contested, "email", "left_semi").select("user_id").unionByName(held.select("user_id"))
    messages = (
        claims.join(involved.distinct(), "user_id", "left_semi")
        .join(contested.withColumn("_contested", F.lit(True)), "email", "left")
        .select(F.lit(1).alias("gen"), "seq", "user_id", "email", F.col("_contested").isNull().alias("sure"))
    )
    return held.unionByName(messages)


_ORDER = ["gen", "seq"]


def _surroundings(claims: DataFrame) -> DataFrame:
    """Add to each claim ``before``: the last claim on its address that may hold it, with what follows that one.

    ``held`` is the last claim on the address that was certainly accepted, with its user's next claim on another. Claims that were refused are not among ``claims``. Each scan is written, as the next one reads its rows twice.
    """
    seq = F.col("seq")
    user = (["user_id"], _ORDER, "slice")
    df = scan(claims, *user, before={"_previous": F.col("email")}, after={"_next": F.struct("seq", "ok"), "_accepted": F.when(F.col("ok"), seq)})
    moves = F.col("_previous").isNotNull() & (F.col("_previous") != F.col("email"))
    df = scan(staged(df), *user, after={"_second": F.struct(F.col("_next.seq").alias("seq")), "_move": F.when(moves, F.struct("seq", "ok"))})
    # Until when the user may still leave this address: for good with the first move that is accepted.
    moved_at, accepted_at = F.col("_move.seq"), F.col("_accepted")
    only = F.col("_second.seq").isNull()
    until = (
        F.when(moved_at.isNull() | (accepted_at < moved_at), None)
        .when(F.col("_move.ok"), F.struct(F.lit(0).alias("ever"), moved_at.alias("seq")))
        .when(accepted_at.isNotNull(), F.struct(F.lit(0).alias("ever"), accepted_at.alias("seq")))
        .when(only, F.struct(F.lit(0).alias("ever"), moved_at.alias("seq")))
        .otherwise(F.struct(F.lit(1).alias("ever"), moved_at.alias("seq")))
    )
    address = (["email"], _ORDER, "slice")
    df = scan(staged(df), *address, greatest_before={"_leavers": until})
    known = F.struct(
        "seq", "user_id", "ok",
        F.col("_next.seq").alias("next"), F.col("_second.seq").alias("second"), accepted_at.alias("accepted"),
        F.col("_leavers").alias("leavers"),
    )
    holder = F.when(F.col("ok"), F.struct("user_id", moved_at.alias("move")))
    return scan(staged(df), *address, before={"before": known, "held": holder}).select(*claims.columns, "before", "held")


def _judged(claims: DataFrame) -> DataFrame:
    """Add ``found``, the outcome of an open claim if it is certain, and ``like``, an earlier claim that has the same."""
    before, held, seq = F.col("before"), F.col("held"), F.col("seq")
    surely_held = held.isNotNull() & (held["move"].isNull() | (held["move"] > seq))
    own = before["user_id"] == F.col("user_id")
    holds, open_ = F.coalesce(before["ok"], F.lit(False)), before["ok"].isNull()
    stayed = before["next"].isNull() | (before["next"] > seq)
    left = F.coalesce(before["accepted"] < seq, F.lit(False))
    one_move = ~stayed & (before["second"].isNull() | (before["second"] > seq))
    # If the claim before was refused, the address is still held by the one who held it then.
    unmoved = before["leavers"].isNull() | ((before["leavers"]["ever"] == 0) & (before["leavers"]["seq"] < before["seq"]))
    still_held = open_ & unmoved & (own | F.col("fresh"))
    found = (
        F.when(F.col("ok").isNotNull(), F.col("ok"))
        .when(surely_held, held["user_id"] == F.col("user_id"))
        .when(before.isNull() | (holds & (own | left)), True)
        .when((holds | still_held) & ~own & stayed, False)
    )
    like = F.when(still_held & (own | left), before["seq"]).when(holds & ~own & ~left & one_move, before["next"])
    return _surroundings(claims).withColumns({"found": found, "like": F.when(found.isNull(), like)}).drop("before", "held")


def _followed(judged: DataFrame) -> DataFrame:
    """``judged`` with the outcomes of claims that point to settled ones, by doubling the pointers."""
    pointers = judged.filter("like IS NOT NULL").select("seq", "like")
    if pointers.isEmpty():
        return judged.drop("like")
    while True:
        further = pointers.select(F.col("seq").alias("like"), F.col("like").alias("_like"))
        pointers = staged(pointers.join(further, "like", "left").select("seq", F.coalesce("_like", "like").alias("like"), F.col("_like").isNotNull().alias("on")))
        if pointers.filter("on").isEmpty():
            break
        pointers = pointers.drop("on")
    ends = judged.filter("gen = 1 AND found IS NOT NULL").select(F.col("seq").alias("like"), F.col("found").alias("_found"))
    known = pointers.join(ends, "like").select("seq", "_found")
    return staged(judged.drop("like").join(known, "seq", "left").withColumn("found", F.coalesce("found", "_found")).drop("_found"))


def _still_needed(claims: DataFrame) -> DataFrame:
    """Open claims, claims on their addresses, and all claims of the users of those."""
    addresses = claims.filter("ok IS NULL").select("email").distinct()
    users = claims.join(addresses, "email", "left_semi").select("user_id").distinct()
    return claims.join(users, "user_id", "left_semi")


def refused_claims(
    claims: DataFrame,
    holders: DataFrame,
    rows_per_slice: int = ROWS_PER_SLICE,
    on_round: Callable[[int], None] | None = None,
) -> DataFrame:
    """``seq`` of every user message refused because its email belongs to another user.

    ``claims(seq, user_id, email)`` are messages that passed the row constraints; ``holders(user_id,
    email)`` is the stored table. Each round tells ``on_round`` how many claims are open before it.
    """
    contested = staged(contested_addresses(claims, holders))
    if contested.isEmpty():
        return claims.select("seq").limit(0)
    events = in_slices(staged(_contest(claims, holders, contested)), ["gen", "seq", "user_id"], rows_per_slice)
    # ``fresh``: the first claim of its user on the address.
    first = events.groupBy("email", "user_id").agg(F.min(F.struct("gen", "seq")).alias("_first"))
    sure = F.when(F.col("sure") | (F.col("gen") == 0), True)
    fresh = F.col("_first") == F.struct("gen", "seq")
    state = events.join(first, ["email", "user_id"]).withColumns({"ok": sure, "fresh": fresh})
    state = staged(state.drop("sure", "_first"))
    refused = []
    while open_claims := state.filter("ok IS NULL").count():
        if on_round:
            on_round(open_claims)
        judged = _followed(staged(_judged(state))).drop("ok").withColumnRenamed("found", "ok")
        refused.append(judged.filter("NOT ok").select("seq"))
        if judged.filter("ok IS NULL").isEmpty():
            break
        state = staged(_still_needed(judged.filter("ok IS NULL OR ok")))
    return reduce(DataFrame.unionByName, refused) if refused else claims.select("seq").limit(0)
