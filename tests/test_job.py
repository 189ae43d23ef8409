"""A business day from an inbox: files found by date, loaded, published, then archived."""

import datetime as dt
import os

import pytest

from cardwatch import schemas as S
from cardwatch.plans import state
from cardwatch.plans.job import load_transaction_days, pending_days, run_business_day
from cardwatch.sources import files, xlsx
from cardwatch.streaming.daily_files import load_transactions_stream

OLD = dt.datetime(1900, 1, 1)


def test_business_day_from_inbox(spark, scratch):
    inbox, archive, root = f"{scratch}/inbox", f"{scratch}/archive", f"{scratch}/wh"
    os.makedirs(inbox)
    with open(f"{inbox}/transactions_01032021.txt", "w") as fh:
        fh.write("transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal\n"
                 "1;2021-03-01 10:00:00;10,50;K1;PAYMENT;SUCCESS;T1\n"
                 "2;2021-03-01 10:30:00;20,00;K1;PAYMENT;SUCCESS;T2\n")
    with open(f"{inbox}/terminals_01032021.xlsx", "wb") as fh:
        fh.write(xlsx.workbook_bytes("terminals", ["terminal_id", "terminal_type", "terminal_city",
                                                   "terminal_address"],
                                     [["T1", "ATM", "Moscow", "a1"], ["T2", "POS", "Kazan", "a2"]]))
    with open(f"{inbox}/passport_blacklist_01032021.xlsx", "wb") as fh:
        fh.write(xlsx.workbook_bytes("blacklist", ["date", "passport"], [["2021-03-01", "PP9"]]))
    bank = {
        "clients": spark.createDataFrame(
            [("c1", "Ivanov", "Ivan", None, OLD, "PP1", dt.datetime(2030, 1, 1), "ph1", OLD, None)],
            S.SRC_CLIENTS),
        "accounts": spark.createDataFrame([("A1", dt.datetime(2030, 1, 1), "c1", OLD, None)], S.SRC_ACCOUNTS),
        "cards": spark.createDataFrame([("K1", "A1", OLD, None)], S.SRC_CARDS),
    }
    out = run_business_day(spark, root, inbox, archive, "2021-03-01", bank,
                           run_ts="2021-03-02 03:36:00")
    rep = [(r.passport, r.fio, r.event_type) for r in state.read_table(spark, root, "rep_fraud").collect()]
    assert rep == [("PP1", "Ivanov Ivan ", 3)]          # Moscow -> Kazan within 30 minutes
    assert sorted(os.listdir(archive)) == ["passport_blacklist_01032021.xlsx.backup",
                                           "terminals_01032021.xlsx.backup",
                                           "transactions_01032021.txt.backup"]
    assert os.listdir(inbox) == []
    assert state.read_table(spark, root, "fact_blacklist").count() == 1
    assert out["state"]["run_id"] == "20210301"
    # the same date again, its files already archived: the same state, once
    before = {n: sorted(map(repr, state.read_table(spark, root, n).collect())) for n in S.WAREHOUSE_TABLES}
    run_business_day(spark, root, inbox, archive, "2021-03-01", bank, run_ts="2021-03-02 03:36:00")
    assert {n: sorted(map(repr, state.read_table(spark, root, n).collect())) for n in S.WAREHOUSE_TABLES} == before


HEADER = "transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal\n"


def _tx_file(folder, day, *ids, body=""):
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/transactions_{day:%d%m%Y}.txt"
    with open(path, "w") as fh:
        fh.write(HEADER + "".join(f"{i};{day} 10:00:00;1,50;K1;PAYMENT;SUCCESS;T1\n" for i in ids) + body)
    return path


def _ids(spark, root):
    return sorted(r.trans_id for r in state.read_table(spark, root, "fact_transactions").collect())


def test_days_of_an_inbox_load_in_order_once(spark, scratch):
    inbox, archive, root = f"{scratch}/in", f"{scratch}/archive", f"{scratch}/wh"
    days = [dt.date(2024, 2, 1), dt.date(2024, 1, 31), dt.date(2023, 12, 31)]
    for i, day in enumerate(days):
        _tx_file(inbox, day, "same", f"own{i}")
    for name in ("transactions_32132024.txt", "transactions_010224.txt", "notes.txt"):
        with open(f"{inbox}/{name}", "w") as fh:
            fh.write("not a day's file")
    assert pending_days(spark, root, inbox, ("transactions",)) == sorted(days)
    assert load_transaction_days(spark, root, inbox, archive) == ["20231231", "20240131", "20240201"]
    assert _ids(spark, root) == ["own0", "own1", "own2", "same"]
    assert state.read_table(spark, root, "fact_transactions").where("trans_id = 'same'").first().trans_date == dt.datetime(2023, 12, 31, 10)
    assert sorted(os.listdir(inbox)) == ["notes.txt", "transactions_010224.txt", "transactions_32132024.txt"]
    ledger = {(r.file_name, r.day, r.run_id) for r in state.read_table(spark, root, "loaded_files").collect()}
    assert ledger == {(f"transactions_{d:%d%m%Y}.txt", f"{d:%Y%m%d}", f"{d:%Y%m%d}") for d in days}
    # a file that came back as it was is archived, not loaded; one that changed is a file of its own
    _tx_file(inbox, days[2], "same", "own2")
    assert load_transaction_days(spark, root, inbox, archive) == []
    assert "transactions_31122023.txt" not in os.listdir(inbox)


def test_files_loaded_before_a_reset_do_not_come_back(spark, scratch):
    """The stream, a reset, the stream again; then a stream with a checkpoint of its own."""
    inbox, root = f"{scratch}/in", f"{scratch}/wh"
    _tx_file(inbox, dt.date(2024, 1, 1), "1")
    load_transactions_stream(spark, root, inbox, f"{scratch}/work")         # no archive: the file stays
    assert _ids(spark, root) == ["1"]
    state.reset(spark, root, "reset")
    _tx_file(inbox, dt.date(2024, 1, 2), "2")
    load_transactions_stream(spark, root, inbox, f"{scratch}/work")
    assert _ids(spark, root) == ["2"]
    _tx_file(inbox, dt.date(2024, 1, 3), "3")
    out = load_transactions_stream(spark, root, inbox, f"{scratch}/new-work", f"{scratch}/archive")
    assert out is not None and _ids(spark, root) == ["2", "3"]
    assert os.listdir(inbox) == [] and len(os.listdir(f"{scratch}/archive")) == 3
    assert load_transactions_stream(spark, root, inbox, f"{scratch}/new-work") is None


def test_a_load_that_stops_after_its_commit_is_not_repeated(spark, scratch, monkeypatch):
    inbox, root = f"{scratch}/in", f"{scratch}/wh"
    _tx_file(inbox, dt.date(2024, 1, 1), "1")
    from cardwatch.streaming import daily_files
    monkeypatch.setattr(daily_files, "archive_files", lambda *a: (_ for _ in ()).throw(OSError("no archive")))
    try:
        load_transactions_stream(spark, root, inbox, f"{scratch}/work", f"{scratch}/archive")
    except OSError:
        pass
    monkeypatch.undo()
    assert load_transactions_stream(spark, root, inbox, f"{scratch}/work", f"{scratch}/archive") is None
    assert _ids(spark, root) == ["1"] and os.listdir(inbox) == []


@pytest.mark.parametrize("pick", [lambda d: d.select("trans_id").collect(), lambda d: d.count(), lambda d: d.collect(), lambda d: d.select("card_num").distinct().count()])
@pytest.mark.parametrize("row", ["2;31.02.2024 25:61;1,5;K;P;S;T\n", "2;2024-01-01 00:00:00;abc;K;P;S;T\n", "2;2024-01-01 00:00:00;1,5;K\n", "2;2024-01-01 00:00:00;1,5;K;P;S;T;more\n"])
def test_a_bad_row_fails_every_projection(spark, scratch, pick, row):
    path = _tx_file(scratch, dt.date(2024, 1, 1), "1", body=row)
    with pytest.raises(Exception, match="MALFORMED_ROW"):
        pick(files.read_transactions(spark, path))
    good, bad = files.read_transactions(spark, path, bad_rows="quarantine")
    assert good.count() == 1 and [r.trans_id for r in good.select("trans_id").collect()] == ["1"]
    assert [r.raw_line for r in bad.collect()] == [row.strip()] and bad.count() == 1


def test_reasons_of_rejected_rows(spark, scratch):
    rows = ["2;31.02.2024 25:61;1,5;K;P;S;T", "3;2024-01-01 00:00:00;abc;K;P;S;T", "4;2024-01-01 00:00:00;1,5;K", "5;2024-01-01 00:00:00;1,5;K;P;S;T;more", '6;;"1,5";"K";;;']
    path = _tx_file(scratch, dt.date(2024, 1, 1), "1", body="\n".join(rows) + "\n\n")
    good, bad = files.read_transactions(spark, path, bad_rows="quarantine")
    assert {r.raw_line[0]: r.reason for r in bad.collect()} == {"2": "transaction_date", "3": "amount", "4": "columns", "5": "columns"}
    assert sorted((r.trans_id, r.trans_date is None, str(r.amt), r.card_num) for r in good.collect()) == [("1", False, "1.50", "K1"), ("6", True, "1.50", "K")]
