"""Fraud report: enrichment, the three rules, priorities and the report rows.

Plan shape (reference profile, all history versions):

* ``card_profiles``: cards -> accounts -> clients, left joins on keys only,
  plus the blacklist marker per passport. Dimension-only, so the large
  fact table is joined once, on ``card_num``.
* ``transactions_at_terminals``: facts inner-joined to terminal versions
  (a terminal without operations cannot raise or change any event: its
  row has no date, so it neither sets a maximum nor passes a gap test).
* rule 3 needs the next operation of the same card: a skew-safe ``lead``
  (see :mod:`cardwatch.operators.sequence`).
* ``event_dt`` is the latest operation of the passport over all rows. It
  is aggregated per card first (a partial aggregate over the facts),
  then mapped to passports through the profiles, and joined only to the
  rows that raised an event.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch import schemas as S
from cardwatch.functions.columns import full_name, within
from cardwatch.operators.sides import sized

# Next-row order inside a card: the date, then tie-breakers so that rows
# which still tie are equal in every column the rules read.
LEAD_ORDER = ["trans_date", "trans_id", "tm_effective_from", "c_effective_from",
              "terminal_city", "passport_num", "last_name", "first_name", "patronymic",
              "phone", "passport_valid_to", "deleted_flg"]

CLIENT_OUT = ["client_id", "last_name", "first_name", "patronymic", "date_of_birth",
              "passport_num", "passport_valid_to", "phone", "deleted_flg"]


def blacklisted_passports(blacklist: DataFrame) -> DataFrame:
    """Distinct non-NULL passports of the blacklist (any entry date)."""
    return (blacklist.select("passport_num").where(F.col("passport_num").isNotNull())
            .distinct().withColumn("blacklisted", F.lit(True)))


def card_profiles(cards: DataFrame, accounts: DataFrame, clients: DataFrame,
                  blacklist: DataFrame | None = None) -> DataFrame:
    """Every (card version x account version x client version) chain, by key only."""
    cards, accounts, clients = sized(cards), sized(accounts), sized(clients)
    cd = cards.select("card_num", F.col("account_num").alias("cd_account_num"))
    a = accounts.select(F.col("account_num").alias("a_account_num"), "client")
    c = clients.select(*CLIENT_OUT, F.col("effective_from").alias("c_effective_from"))
    prof = (cd.join(a, F.col("cd_account_num") == F.col("a_account_num"), "left")
            .join(c, F.col("client") == F.col("client_id"), "left")
            .drop("cd_account_num", "a_account_num", "client"))
    if blacklist is not None:
        prof = (prof.join(blacklisted_passports(sized(blacklist)), "passport_num", "left")
                .withColumn("blacklisted", F.coalesce("blacklisted", F.lit(False))))
    return prof


def transactions_at_terminals(terminals: DataFrame, transactions: DataFrame) -> DataFrame:
    tm = terminals.select(F.col("terminal_id"), "terminal_city",
                          F.col("effective_from").alias("tm_effective_from"))
    t = transactions.select("trans_id", "trans_date", "card_num", "terminal")
    return (t.join(sized(tm), F.col("terminal") == F.col("terminal_id"), "inner")
            .drop("terminal_id"))


def enrich(terminals: DataFrame, transactions: DataFrame, cards: DataFrame,
           accounts: DataFrame, clients: DataFrame, blacklist: DataFrame | None = None,
           as_of: bool = False) -> DataFrame:
    """FRD-1: one row per operation and combination of dimension versions.

    ``as_of=True`` keeps only the version of each dimension that was valid
    at the operation time (``effective_from <= trans_date < effective_to``);
    an operation without a whole chain of card, account and client has no client.
    """
    if as_of:
        return _enrich_as_of(terminals, transactions, cards, accounts, clients, blacklist)
    tx = transactions_at_terminals(terminals, transactions)
    prof = card_profiles(cards, accounts, clients, blacklist)
    out = tx.join(sized(prof, like=cards), "card_num", "left")
    if blacklist is not None:   # an operation with no card profile has no passport
        out = out.withColumn("blacklisted", F.coalesce("blacklisted", F.lit(False)))
    return out


def _valid_at(ts: Column, frm: Column, to: Column) -> Column:
    return (frm <= ts) & (ts < to)


#: Rows of terminal versions up to which the terminal side is broadcast (counted first); beyond, a shuffle join.
BROADCAST_VERSIONS = 500_000


def small_side(df: DataFrame, limit: int = BROADCAST_VERSIONS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``limit`` rows (counted, one small job)."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def card_timeline(cards: DataFrame, accounts: DataFrame, clients: DataFrame,
                  blacklist: DataFrame | None = None) -> DataFrame:
    """Segments [seg_from, seg_to) of each card in which one client version holds.

    The validities of a card version, of its account's versions and of their
    client's versions are intersected, dimension against dimension (shuffled if large); empty
    intersections, and versions without a key or a bound, drop out. With one
    version of each key at a time (as the keyed profile keeps them) the
    segments of a card do not overlap; where versions overlap, each chain has its own.
    """
    cards, accounts, clients = sized(cards), sized(accounts), sized(clients)
    cd = cards.select("card_num", F.col("account_num").alias("_account"),
                      F.col("effective_from").alias("_cd_from"), F.col("effective_to").alias("_cd_to"))
    a = accounts.select(F.col("account_num").alias("_a_account"), F.col("client").alias("_client"),
                        F.col("effective_from").alias("_a_from"), F.col("effective_to").alias("_a_to"))
    c = clients.select(*CLIENT_OUT, F.col("effective_from").alias("c_effective_from"), F.col("effective_to").alias("_c_to"))
    # greatest/least skip NULLs, and a version with a NULL bound holds never
    ca = (cd.join(a, (F.col("_account") == F.col("_a_account")) & (F.col("_cd_from") < F.col("_a_to")) & (F.col("_a_from") < F.col("_cd_to")))
          .where("_cd_from < _cd_to and _a_from < _a_to")
          .select("card_num", "_client", F.greatest("_cd_from", "_a_from").alias("_from"), F.least("_cd_to", "_a_to").alias("_to")))
    line = (ca.join(c, (F.col("_client") == F.col("client_id")) & (F.col("_from") < F.col("_c_to")) & (F.col("c_effective_from") < F.col("_to")))
            .where("c_effective_from < _c_to")
            .select("card_num", F.greatest("_from", "c_effective_from").alias("seg_from"), F.least("_to", "_c_to").alias("seg_to"),
                    *CLIENT_OUT, "c_effective_from"))
    if blacklist is not None:
        line = (line.join(blacklisted_passports(sized(blacklist)), "passport_num", "left")
                .withColumn("blacklisted", F.coalesce("blacklisted", F.lit(False))))
    return line


def _enrich_as_of(terminals, transactions, cards, accounts, clients, blacklist):
    """One exchange of the operations, on the card: the versions meet among themselves
    first (:func:`card_timeline`), then every operation takes the segment that holds it.
    A hot card is one of the operations' side, which AQE splits; its segments are few.
    """
    t = transactions.select("trans_id", "trans_date", "card_num", "terminal")
    tm = terminals.select("terminal_id", "terminal_city", F.col("effective_from").alias("tm_effective_from"),
                          F.col("effective_to").alias("_tm_to"))
    ts = F.col("trans_date")
    tx = (t.join(small_side(tm), (F.col("terminal") == F.col("terminal_id"))
                 & _valid_at(ts, F.col("tm_effective_from"), F.col("_tm_to")), "inner").drop("terminal_id", "_tm_to"))
    line = sized(card_timeline(cards, accounts, clients, blacklist).withColumnRenamed("card_num", "_line_card"), like=cards)
    df = tx.join(line, (F.col("card_num") == F.col("_line_card")) & _valid_at(ts, F.col("seg_from"), F.col("seg_to")), "left")
    df = df.select("trans_id", "trans_date", "card_num", "terminal", "terminal_city",
                   "tm_effective_from", *CLIENT_OUT, "c_effective_from",
                   *(["blacklisted"] if blacklist is not None else []))
    return df if blacklist is None else df.withColumn("blacklisted", F.coalesce("blacklisted", F.lit(False)))


def rule_passport(df: DataFrame) -> Column:
    """FRD-2: passport expired at operation time, or on the blacklist."""
    return (F.col("passport_valid_to") < F.col("trans_date")) | F.col("blacklisted")


def rule_closed(df: DataFrame) -> Column:
    """FRD-3: the client's row is flagged deleted."""
    return F.col("deleted_flg") == 1


def per_card(tx: DataFrame) -> DataFrame:
    """Operations and latest time per card: one partial aggregate over the facts, for every use of either."""
    return tx.groupBy("card_num").agg(F.count(F.lit(1)).alias("card_rows"), F.max("trans_date").alias("card_last"))


def with_next_operation(df: DataFrame, skew_safe: bool = True, tx: DataFrame | None = None,
                        profiles: DataFrame | None = None, cards: DataFrame | None = None) -> DataFrame:
    """Adds ``next_terminal_city`` and ``next_trans_date`` of the same card.

    ``tx`` (the operations before the fan-out join), or ``cards`` from :func:`per_card`, gives the rows per card
    that decide which cards are hot, from a cheap partial aggregate instead
    of the enriched rows; ``profiles`` multiplies them by the card's profile rows.
    """
    from cardwatch.operators.sequence import key_stats, lead_columns
    stats = key_stats(tx, ["card_num"]) if tx is not None else None
    if cards is not None:
        stats = cards.select(F.struct("card_num").alias(key_stats(cards, ["card_num"]).columns[0]), F.col("card_rows").alias("_n"))
    if stats is not None and profiles is not None:
        fan = key_stats(profiles, ["card_num"]).withColumnRenamed("_n", "_fan")
        key = stats.columns[0]
        stats = stats.join(fan, key, "left").select(key, (F.col("_n") * F.coalesce("_fan", F.lit(1))).alias("_n"))
    return lead_columns(df, ["card_num"], LEAD_ORDER, ["terminal_city", "trans_date"],
                        skew_safe=skew_safe, stats=stats)


def rule_city_hop(df: DataFrame, max_gap: str = "60 days") -> Column:
    """FRD-4: the card's next operation is in another city within ``max_gap``."""
    return ((F.col("next_terminal_city") != F.col("terminal_city"))
            & within(F.col("next_trans_date"), F.col("trans_date"), max_gap))


def event_type(df: DataFrame, max_gap: str = "60 days") -> Column:
    """FRD-5: rule priority 1 > 2 > 3, else 0."""
    return (F.when(rule_passport(df), 1).when(rule_closed(df), 2)
            .when(rule_city_hop(df, max_gap), 3).otherwise(0))


def last_event_by_passport(tx: DataFrame, profiles: DataFrame, cards: DataFrame | None = None) -> DataFrame:
    """FRD-6: latest operation time per passport over all enriched rows.

    Pre-aggregated per card (partial aggregate over the facts), then
    mapped through the card profiles; an operation whose card has no
    profile belongs to the NULL passport, as in the left-joined rows. ``cards``: what :func:`per_card` gives for ``tx``.
    """
    cards = per_card(tx) if cards is None else cards
    links = profiles.select("card_num", "passport_num")
    return (cards.join(links, "card_num", "left")
            .groupBy("passport_num").agg(F.max("card_last").alias("event_dt")))


def report_date(stg_transactions: DataFrame) -> DataFrame:
    """FRD-7: one row, the latest operation time of the day (NULL if none)."""
    return stg_transactions.agg(F.max("trans_date").alias("report_dt"))


EVENT_COLS = ["event_dt", "passport_num", "last_name", "first_name", "patronymic",
              "phone", "event_type", "report_dt"]


def report_events(terminals, transactions, cards, accounts, clients, blacklist,
                  stg_transactions, max_gap: str = "60 days", as_of: bool = False,
                  skew_safe: bool = True, materialize=None) -> DataFrame:
    """FRD-9: distinct event rows (before the name is assembled), type > 0.

    In the as-of form the enriched rows feed both the next-operation
    lookup and the last event per passport; ``materialize`` (e.g. a
    Parquet write in the checkpoint folder) makes them one evaluation of
    the version joins instead of two. In the other form it holds the card profiles (three
    uses) and the counts and last times per card (two), so that the
    operations are read twice: once for these, once for the rows themselves.
    """
    tx, prof, cards_seen = transactions.select("trans_id", "trans_date", "card_num"), None, None
    if as_of:
        enriched = _enrich_as_of(terminals, transactions, cards, accounts, clients, blacklist)
        if materialize is not None:
            enriched = materialize(enriched)
        links = enriched.select("card_num", "passport_num", "trans_date")
        last = links.groupBy("passport_num").agg(F.max("trans_date").alias("event_dt"))
    else:
        tx = transactions_at_terminals(terminals, transactions)
        prof, cards_seen = card_profiles(cards, accounts, clients, blacklist), per_card(tx)
        if materialize is not None:
            prof, cards_seen = materialize(prof), materialize(cards_seen)
        prof = sized(prof, like=cards)
        enriched = tx.join(prof, "card_num", "left")
        last = last_event_by_passport(tx, prof, cards_seen)
    seq = with_next_operation(enriched, skew_safe=skew_safe, tx=None if cards_seen is not None else tx, profiles=prof, cards=cards_seen)
    events = (seq.select(*[c for c in seq.columns if c not in ("event_type",)],
                         event_type(seq, max_gap).alias("event_type"))
              .where(F.col("event_type") > 0))
    # event_dt follows from the passport: distinct rows first, then the join
    events = events.select(*[c for c in EVENT_COLS if c not in ("event_dt", "report_dt")]).distinct()
    ev, ls = events.alias("e"), sized(last, like=clients).alias("p")
    events = ev.join(ls, F.col("e.passport_num").eqNullSafe(F.col("p.passport_num")), "left")
    # one value for the whole report: a scalar subquery, evaluated once
    rd = report_date(stg_transactions).scalar()
    return (events.select(F.col("p.event_dt"), F.col("e.passport_num"), "e.last_name",
                          "e.first_name", "e.patronymic", "e.phone", "e.event_type",
                          rd.alias("report_dt"))
            .select(*EVENT_COLS))


def fraud_report(terminals, transactions, cards, accounts, clients, blacklist,
                 stg_transactions, max_gap: str = "60 days", as_of: bool = False,
                 skew_safe: bool = True, materialize=None) -> DataFrame:
    """FRD-11: rows of the fraud report (columns of ``rep_fraud``)."""
    ev = report_events(terminals, transactions, cards, accounts, clients, blacklist,
                       stg_transactions, max_gap, as_of, skew_safe, materialize)
    return ev.select("event_dt", F.col("passport_num").alias("passport"),
                     full_name("last_name", "first_name", "patronymic").alias("fio"),
                     "phone", F.col("event_type").cast("int").alias("event_type"), "report_dt")


# ---- the day's report: only the day's rows, and what they decide about earlier ones ----

def own_event_type(df: DataFrame) -> Column:
    """Rules 1 and 2, which an operation's own row decides; else 0."""
    return F.coalesce(F.when(rule_passport(df), 1).when(rule_closed(df), 2), F.lit(0)).cast("int")


def carry_rows(enriched: DataFrame) -> DataFrame:
    """Enriched operations as ``carry_cards`` keeps them."""
    return enriched.withColumn("event_type", own_event_type(enriched)).select(*S.CARRY_CARDS.fieldNames())


def carried_cards(*rows: DataFrame) -> DataFrame:
    """The last row of each card in the order of :data:`LEAD_ORDER` (a partial aggregate; NULL is a card too)."""
    from cardwatch.operators.sequence import sort_struct
    cols = S.CARRY_CARDS.fieldNames()
    every = reduce(DataFrame.unionByName, [r.select(*cols) for r in rows])
    last = every.groupBy("card_num").agg(F.max_by(F.struct(*cols[1:]), sort_struct(LEAD_ORDER)).alias("_r"))
    return last.select("card_num", "_r.*")


def carried_passports(carry: DataFrame | None, rows: DataFrame) -> DataFrame:
    """Latest operation per passport: what was carried, moved on by ``rows``."""
    new = rows.select("passport_num", F.col("trans_date").alias("event_dt"))
    every = new if carry is None else carry.select("passport_num", "event_dt").unionByName(new)
    return every.groupBy("passport_num").agg(F.max("event_dt").alias("event_dt"))


def carry_from_history(terminals, transactions, cards, accounts, clients, blacklist, materialize) -> tuple[DataFrame, DataFrame]:
    """(carry_cards, carry_passports) of operations that no day's report has covered yet: one pass over them."""
    rows = materialize(carry_rows(_enrich_as_of(terminals, transactions, cards, accounts, clients, blacklist)))
    return materialize(carried_cards(rows)), materialize(carried_passports(None, rows))


def day_report(terminals, day_transactions, cards, accounts, clients, blacklist, stg_transactions,
               carry_cards: DataFrame, carry_passports: DataFrame, max_gap: str = "60 days", materialize=None,
               skew_safe: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Report scope "rows of the day": (report rows, new carry_cards, new carry_passports).

    ``day_transactions`` are the operations that the run adds. An operation is
    judged on its own day by rules 1 and 2, and by rule 3 when its card's next
    operation is there: that of the last operation of an earlier day arrives
    later, so it is carried, and reported by the day that brings the next one
    (unless its own day reported it). ``event_dt`` is the passport's latest
    operation so far. The reports of consecutive days hold together what one
    report over all of them holds, a type 3 row on the later day. An operation that arrives
    late, before the carried one in time, is followed by the next of the day's
    and the carried operation; a passport that enters the blacklist later does not bring earlier days back.

    Reads the day's operations, the dimensions and the two carried tables (one row a card, one a
    passport); never the facts of earlier days. Carried rows are of this profile: versions valid at the operation.
    """
    from cardwatch.operators.sequence import key_stats, lead_columns
    today = carry_rows(_enrich_as_of(terminals, day_transactions, cards, accounts, clients, blacklist))
    if materialize is not None:
        today = materialize(today)
    # a struct is never NULL: operations without a card follow one another too
    key = F.struct("card_num").alias("_card")
    seen = sized(today.select(key).distinct(), like=today if materialize is not None else day_transactions)
    earlier = carry_cards.select("*", key).join(seen, "_card", "left_semi").drop("_card")
    rows = today.withColumn("_new", F.lit(True)).unionByName(earlier.withColumn("_new", F.lit(False)))
    seq = lead_columns(rows, ["card_num"], LEAD_ORDER, ["terminal_city", "trans_date"], skew_safe=skew_safe,
                       stats=key_stats(today, ["card_num"]))
    hop = (F.col("event_type") == 0) & F.coalesce(rule_city_hop(seq, max_gap), F.lit(False))
    events = (seq.withColumn("_type", F.when(hop, 3).otherwise(F.col("event_type")))
              .where(hop | (F.col("_new") & (F.col("event_type") > 0))))
    new_cards, new_passports = carried_cards(carry_cards, today), carried_passports(carry_passports, today)
    if materialize is not None:
        new_cards, new_passports = materialize(new_cards), materialize(new_passports)
    ev, ls = events.alias("e"), sized(new_passports, like=new_passports if materialize is not None else clients).alias("p")
    events = ev.join(ls, F.col("e.passport_num").eqNullSafe(F.col("p.passport_num")), "left")
    report = (events.select(F.col("p.event_dt"), F.col("e.passport_num").alias("passport"),
                            full_name("e.last_name", "e.first_name", "e.patronymic").alias("fio"), "e.phone",
                            F.col("e._type").cast("int").alias("event_type"), report_date(stg_transactions).scalar().alias("report_dt")).distinct())
    return report, new_cards, new_passports
