"""Daily file readers: text edge cases, quarantine, XLSX cells and dates."""

import datetime as dt
import decimal
import io
import os
import zipfile

import pytest

from cardwatch import schemas as S
from cardwatch.plans import state
from cardwatch.sources import files, xlsx
from cardwatch.streaming.daily_files import load_transactions_stream

HEADER = "transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal\n"


def _write(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)
    return path


def test_transactions_text_edge_cases(spark, scratch):
    path = _write(scratch, "transactions_01032021.txt", HEADER +
                  '1;2021-03-01 10:00:00;1234,5;4000 0000 0000 0001  ;PAYMENT;SUCCESS;T1\n'
                  '2;2021-03-01 10:05:00;77,126;C2;WITHDRAW;REJECT;T2\n'
                  '3;2021-03-01 10:06:00;5;C3;;"";T3\n'
                  '3;2021-03-01 10:07:00;6;C3;PAYMENT;SUCCESS;T3\n')
    rows = sorted(files.read_transactions(spark, path).collect(), key=lambda r: (r.trans_id, r.trans_date))
    assert rows[0].amt == decimal.Decimal("1234.50")            # decimal comma
    assert rows[0].card_num == "4000 0000 0000 0001"             # trailing blanks trimmed
    assert rows[1].amt == decimal.Decimal("77.13")               # rounded to 2 digits
    assert rows[2].oper_type is None and rows[2].oper_result is None   # blank and quoted-empty
    assert [r.trans_id for r in rows] == ["1", "2", "3", "3"]     # repeated id kept
    assert rows[0].trans_date == dt.datetime(2021, 3, 1, 10, 0)


def test_bad_row_fails_or_goes_to_quarantine(spark, scratch):
    path = _write(scratch, "transactions_02032021.txt", HEADER +
                  '1;2021-03-02 10:00:00;1,5;C1;PAYMENT;SUCCESS;T1\n'
                  '2;not a date;2,5;C2;PAYMENT;SUCCESS;T1\n')
    with pytest.raises(Exception):
        files.read_transactions(spark, path).collect()
    good, bad = files.read_transactions(spark, path, bad_rows="quarantine")
    assert [r.trans_id for r in good.collect()] == ["1"]
    assert [r.raw_line for r in bad.collect()] == ["2;not a date;2,5;C2;PAYMENT;SUCCESS;T1"]


def test_header_only_file_has_no_day(spark, scratch):
    from cardwatch.operators.cdc import day_max
    path = _write(scratch, "transactions_03032021.txt", HEADER)
    df = files.read_transactions(spark, path)
    assert df.count() == 0
    assert day_max(df).first()[0] is None


def test_daily_path():
    assert files.daily_path("/in", "blacklist", "2021-03-01") == "/in/passport_blacklist_01032021.xlsx"


def _shared_string_workbook(path):
    """A workbook in the usual spreadsheet-program layout: shared strings, dates as serials."""
    sst = ('<sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
           '<si><t>date</t></si><si><t>passport</t></si><si><t>4010 123456</t></si></sst>')
    sheet = ('<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>'
             '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c></row>'
             '<row r="2"><c r="A2"><v>44256.5</v></c><c r="B2" t="s"><v>2</v></c></row>'
             '<row r="3"><c r="A3" t="inlineStr"><is><t>2021-03-02</t></is></c><c r="B3"><v>4011222333</v></c></row>'
             '<row r="4"><c r="A4" t="inlineStr"><is><t>NaT</t></is></c><c r="B4" t="inlineStr"><is><t>X1</t></is></c></row>'
             '</sheetData></worksheet>')
    wb = ('<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" '
          'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>'
          '<sheet name="other" sheetId="1" r:id="rId2"/><sheet name="blacklist" sheetId="2" r:id="rId1"/>'
          '</sheets></workbook>')
    rels = ('<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
            '<Relationship Id="rId1" Type="worksheet" Target="worksheets/sheet2.xml"/>'
            '<Relationship Id="rId2" Type="worksheet" Target="worksheets/sheet1.xml"/></Relationships>')
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", wb)
        z.writestr("xl/_rels/workbook.xml.rels", rels)
        z.writestr("xl/sharedStrings.xml", sst)
        z.writestr("xl/worksheets/sheet2.xml", sheet)
        z.writestr("xl/worksheets/sheet1.xml", sheet.replace("4010", "9999"))


def test_blacklist_xlsx_cells_and_dates(spark, scratch):
    path = os.path.join(scratch, "passport_blacklist_01032021.xlsx")
    _shared_string_workbook(path)
    rows = sorted(xlsx.read_blacklist(spark, path).collect(), key=lambda r: r.passport_num)
    assert [(r.entry_dt, r.passport_num) for r in rows] == [
        (dt.datetime(2021, 3, 1, 12, 0), "4010 123456"),     # serial date, shared string
        (dt.datetime(2021, 3, 2), "4011222333"),              # text date, numeric cell
        (None, "X1"),                                         # NaT -> NULL
    ]


def test_terminals_xlsx_round_trip_and_missing_sheet(spark, scratch):
    rows = [("T1", "ATM", "Moscow", "Lenina 1"), ("T2", "POS", None, "Mira & 2 <b>")]
    df = spark.createDataFrame(rows, "terminal_id string, terminal_type string, "
                                     "terminal_city string, terminal_address string")
    folder = f"{scratch}/books"
    xlsx.write_sheets(df, folder, "terminals", rows_per_book=1)
    back = sorted(tuple(r) for r in xlsx.read_terminals(spark, folder).collect())
    assert back == sorted(rows)
    assert len([f for f in os.listdir(folder) if f.startswith("part-") and os.path.getsize(f"{folder}/{f}")]) == 2
    with pytest.raises(Exception, match="no sheet named"):
        xlsx.read_sheet(spark, folder, "blacklist", 2).collect()


def test_xlsx_phonetic_runs_and_1904_dates(spark, scratch):
    path = os.path.join(scratch, "passport_blacklist_02032021.xlsx")
    data = xlsx.workbook_bytes("blacklist", ["date", "passport"], [[42794.5, "P1"]])
    src, out = zipfile.ZipFile(io.BytesIO(data)), zipfile.ZipFile(path, "w")
    for name in src.namelist():
        text = src.read(name).decode()
        text = text.replace("<sheets>", '<workbookPr date1904="1"/><sheets>')
        text = text.replace("<t>P1</t>", "<r><t>P</t></r><r><t>1</t></r><rPh sb=\"0\" eb=\"1\"><t>xyz</t></rPh>")
        out.writestr(name, text)
    out.close()
    rows = xlsx.read_blacklist(spark, path).collect()
    assert [(r.entry_dt, r.passport_num) for r in rows] == [(dt.datetime(2021, 3, 1, 12, 0), "P1")]


def test_quarantine_is_the_same_for_every_projection(spark, scratch):
    path = _write(scratch, "transactions_03032021.txt", HEADER +
                  '1;2021-03-02 10:00:00;1,5;C1;PAYMENT;SUCCESS;T1\n'
                  '2;not a date;2,5;C2;PAYMENT;SUCCESS;T1\n')
    good, bad = files.read_transactions(spark, path, bad_rows="quarantine")
    assert good.count() == 1 and bad.count() == 1
    assert [r.trans_id for r in good.select("trans_id").collect()] == ["1"]
    assert [r.card_num for r in good.select("card_num").collect()] == ["C1"]


def test_bank_keys_are_trimmed(spark):
    raw = spark.createDataFrame([("4000 1   ", "A1  ", None, None), ("    ", " A2 ", None, None)], S.SRC_CARDS)
    rows = [(r.card_num, r.account) for r in files.conform_bank(raw, "cards").collect()]
    assert rows == [("4000 1", "A1"), (None, " A2")]


@pytest.mark.parametrize("files_per_batch", [1, 2, None])
def test_stream_rows_do_not_depend_on_batches(spark, scratch, files_per_batch):
    inbox, root = f"{scratch}/inbox", f"{scratch}/wh"
    os.makedirs(inbox)
    row = "{};2021-03-0{} 10:00:0{};1,5;C1;PAYMENT;SUCCESS;T1\n"
    _write(inbox, "transactions_01032021.txt", HEADER + row.format(1, 1, 0) + row.format(1, 1, 1) + row.format("", 1, 2))
    _write(inbox, "transactions_02032021.txt", HEADER + row.format(1, 2, 3) + row.format(2, 2, 4))
    _write(inbox, "transactions_03032021.txt", HEADER + row.format(2, 3, 5) + row.format(7, 3, 6))
    old = spark.createDataFrame([("7", dt.datetime(2021, 2, 1), None, "C", "P", "S", "T")], S.FACT_TRANSACTIONS)
    state.publish(spark, root, "0", append={"fact_transactions": old})
    load = lambda: load_transactions_stream(spark, root, inbox, f"{scratch}/work", f"{scratch}/archive", files_per_batch)
    load()
    facts = lambda: sorted((r.trans_id or "", r.trans_date.second) for r in state.read_table(spark, root, "fact_transactions").collect())
    want = [("", 2), ("1", 0), ("1", 1), ("2", 4), ("7", 0)]
    assert facts() == want
    assert os.listdir(inbox) == [] and len(os.listdir(f"{scratch}/archive")) >= 3
    assert load() is None and facts() == want      # nothing new
    _write(inbox, "transactions_04032021.txt", HEADER + row.format(9, 4, 7))
    load()
    assert facts() == sorted([*want, ("9", 7)])


def test_a_workbook_is_pulled_row_by_row(spark, scratch, monkeypatch):
    """30,000 rows of shared and own strings: memory stays far below that of the parsed sheet; frames are bounded."""
    n, m = 30_000, 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    _shared_string_workbook(path := os.path.join(scratch, "book.xlsx"))
    src, buf = zipfile.ZipFile(path), io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for name in ("xl/workbook.xml", "xl/_rels/workbook.xml.rels"):
            z.writestr(name, src.read(name))
        z.writestr("xl/sharedStrings.xml", f"<sst {m}>" + "".join(f"<si><t>é{i}</t></si>" for i in range(n)) + "</sst>")
        z.writestr("xl/worksheets/sheet2.xml", f"<worksheet {m}><sheetData>" + "".join(
            f'<row r="{i + 1}"><c r="A{i + 1}"><v>{i}</v></c><c r="B{i + 1}" t="s"><v>{n - 1 - i}</v></c></row>' for i in range(n)) + "</sheetData></worksheet>")
    import tracemalloc
    tracemalloc.start()
    rows = sum(1 for _ in xlsx.sheet_rows(buf.getvalue(), "blacklist", 2))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == n and peak < 5_000_000        # the tree of this sheet takes some 50 MB
    with open(path, "wb") as fh:
        fh.write(buf.getvalue())
    monkeypatch.setattr(xlsx, "FRAME_ROWS", 1000)
    got = xlsx.read_sheet(spark, path, "blacklist", 2)
    assert got.count() == n - 1 and got.where(f"c0 = '{n - 1}'").first().c1 == "é0"
    bad = buf.getvalue()
    with pytest.raises(ValueError, match="no shared string"):
        xlsx.SharedStrings(zipfile.ZipFile(io.BytesIO(bad)))[n]
