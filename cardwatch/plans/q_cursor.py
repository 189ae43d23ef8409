"""A cursor per source table (CDC-1, CDC-6, keyed): three captures, each into the history that the one before left."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardwatch import schemas as S
from cardwatch.catalog import register
from cardwatch.operators import cdc, scd2
from cardwatch.plans import q_scd
from cardwatch.plans.daily import BANK_CAPTURE
from cardwatch.plans.inputs import run_ts, stored_history
from cardwatch.plans.q_cdc import CAPTURE_SQL, RUN
from cardwatch.plans.state import materializer

_ATTRS = ("last_name", "first_name", "patronymic", "date_of_birth", "passport_num", "passport_valid_to", "phone")
_OVERLAP = "8 days"


def _cursor_sql() -> str:
    cols = ", ".join(("client_id", *_ATTRS))
    ctes, hist = [], "fx_clients_hist"
    for n in (1, 2, 3):
        if n == 1:
            stg = f"select {cols}, create_dt, {RUN} update_dt from d1_clients_src"
            at = "select max(update_dt) seen from d1_clients_src"
        else:
            prev = f"(select seen from at{n - 1})"
            same = " and ".join(f"t.{a} is not distinct from s.{a}" for a in _ATTRS)
            stg = f"""select {cols}, create_dt, {RUN} update_dt from d{n}_clients_src s
  where (update_dt > {prev} - interval {_OVERLAP}
         and not (update_dt <= {prev} and exists (select 1 from {hist} t where t.client_id = s.client_id and t.deleted_flg = 0
                  and t.effective_to = timestamp '9999-12-31 00:00:00' and {same})))
     or (update_dt is null and not exists (select 1 from {hist} t where t.client_id = s.client_id))"""
            at = f"select greatest(max(update_dt), {prev}) seen from d{n}_clients_src where update_dt > {prev} - interval {_OVERLAP}"
        ctes += [f"at{n} as ({at})", f"cap{n} as ({stg})"]
        if n < 3:
            body, last = q_scd.prefixed(q_scd.keyed_sql("clients", "flag_deleted"), f"c{n}_")
            body = body.replace(CAPTURE_SQL["clients"], f"select * from cap{n}").replace("fx_clients_src", f"d{n}_clients_src").replace("fx_clients_hist", hist)
            ctes.append(body)
            hist = last
    return "with " + ",\n".join(ctes) + "\n" + "\nunion all\n".join(
        f"select {n} capture, client_id, phone, passport_valid_to, (select seen from at{n}) last_update_dt from cap{n}" for n in (1, 2, 3))


@register("cdc_cursor_keyed", _cursor_sql())
def cdc_cursor_keyed(fx):
    """CDC-1, CDC-6, keyed: the first capture creates the cursor, later ones move it to the latest change they saw."""
    mat, out = materializer(fx.spark), None
    hist, meta = stored_history(fx, "fx_clients_hist"), fx["fx_meta"]
    key, src_key, columns = BANK_CAPTURE["clients"]
    for n in (1, 2, 3):
        src = mat(fx[f"d{n}_clients_src"])
        stg, at = cdc.capture_since(src, cdc.cursor(meta, "bank", "clients"), _OVERLAP, hist, key, S.CLIENTS.attrs, columns, run_ts(), src_key=src_key)
        stg = mat(stg)
        meta = mat(cdc.advance_cursors(meta, {("bank", "clients"): at}))
        mine = meta.where("table_db = 'bank'").select("last_update_dt").scalar()
        part = stg.select(F.lit(n).alias("capture"), "client_id", "phone", "passport_valid_to", mine.alias("last_update_dt"))
        out = part if out is None else out.unionByName(part)
        if n < 3:
            hist = mat(scd2.apply_day(hist, stg, cdc.key_snapshot(src, src_key, key), S.CLIENTS, run_ts(), None, "keyed", materialize=mat))
    return out
