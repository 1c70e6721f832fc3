"""Named pivot sets of the standing reports."""

from __future__ import annotations

from shipreport.operators.pivots import Measure, Pivot

_ROW_SHARE = "% of Row Total"


def _n(name: str = "JUMLAH", field: str = "AWB") -> Measure:
    return Measure(field, "count", name)


def _share(name: str, of: str) -> Measure:
    return Measure("AWB", "count", name, of)


def _by(name: str, rows, columns=(), values=None, **options) -> Pivot:
    rows = [rows] if isinstance(rows, str) else list(rows)
    columns = [columns] if isinstance(columns, str) else list(columns)
    return Pivot(name, rows, columns, list(values or [_n()]), **options)


def _with_share(name: str, rows, columns=(), label: str = "JUMLAH %", **options) -> Pivot:
    return _by(name, rows, columns, [_n(), _share(label, "column")], **options)


# The pivots of each set.
PRESETS: dict[str, list[Pivot]] = {
    "pivot_standard": [
        _by("PivotStatus", "STATUS_POD"),
        _by("Pivot3LC", "3 LC DEST", values=[_n(), Measure("AMOUNT", "sum", "JUMLAH_AMOUNT")]),
        _by("PivotCarrer", "CARRER"),
    ],
    "pivot_status_by_awb": [_with_share("PivotStatusByAWB", "STATUS_POD")],
    "pivot_status_by_periode": [_by("PivotStatus", "STATUS_POD", "PERIODE")],
    "pivot_aj_car": [
        _by("AllSummary", ["AJ Car Status", "KETERANGAN AJ CAR", "CODING_UNDEL", "REASON UNDEL"], values=[_n("Total")]),
        _by("ReasonReturnSummary", "REASON UNDEL", values=[_n("Total")], hide_blank=True),
        _by("StatusbyTglEntry", "TGL_ENTRY", "AJ Car Status", [_n("Total")]),
        _by("StatusbyTglEntryPercent", "TGL_ENTRY", "AJ Car Status", [_share(_ROW_SHARE, "row")]),
    ],
    "pivot_status_by_dest": [_by("PivotStatusByDest", "3 LC DEST", "STATUS_POD")],
    "pivot_status_by_id": [_by("PivotStatusById", "STATUS_POD", "ID_ACCOUNT")],
    "pivot_status_by_id_tgl_entry": [_by("PivotStatusByIdTglEntry", ["ID_ACCOUNT", "STATUS_POD"], "TGL_ENTRY")],
    "pivot_status_by_3LC": [_by("PivotStatusBy3LC", "3 LC DEST", "STATUS_POD")],
    "pivot_pzc": [_by("PivotPZC", "DEPT PZC", "STATUS_POD")],
    "pivot_watson": [
        _by("PivotStatusWatson", "STATUS_POD"),
        _by("PivotOriginWatson", ["ORIGIN 2", "ORIGIN"]),
        _by("PivotCarrerPercentWatson", "STATUS_POD", "CARRER", [_share(_ROW_SHARE, "row")]),
        _by("PivotCarrerWatson", "STATUS_POD", "CARRER"),
    ],
    "pivot_reason_return": [_by("PivotReasonReturn", "REASON RETURN", filters=[("STATUS_POD", "Undel")])],
    "pivot_uob": [
        _by("PivotCycleNameByStatus", "CYCLE NAME", "STATUS", [_n(field="REFF NUM")]),
        _by("PivotCycleNameByKetAWB", "CYCLE NAME", "KET AWB", [_n(field="REFF NUM")]),
    ],
    "pivot_map_aktif": [
        _by("PivotStatusMapAktif", ["PERIODE", "WEEK_OF_YEAR"], "CARRER", [_n(), _share(_ROW_SHARE, "row")]),
    ],
    "pivot_status_by_tgl_entry": [
        _with_share("PivotStatusByTglEntry", "STATUS_POD", "TGL_ENTRY", _ROW_SHARE, sort=(_ROW_SHARE, "desc")),
    ],
    "pivot_rodamas": [
        _with_share("PivotStatusRodamas", "STATUS_POD", label=_ROW_SHARE),
        _with_share("PivotServiceRodamas", "SERVICE", label=_ROW_SHARE),
        _with_share("PivotCustomerRodamas", "CUSTOMER", label=_ROW_SHARE),
        _with_share("PivotStatusByTglEntry", "TGL_ENTRY", label=_ROW_SHARE),
    ],
    "pivot_template_zilong": [
        _by("PivotStatusZilong", "STATUS_POD"),
        _by("PivotZonaZilong", "ZONA"),
        _by("PivotCustomerNameZilong", "CUST_NAME"),
        _by("PivotRegionalZilong", "REGIONAL"),
        _by("PivotCarrer1stZilong", "CAREER_1ST", hide_blank=True),
        _by("PivotWilayahZilong", "WILAYAH"),
        _by("PivotCarrerPODZilong", "CARRER_POD", hide_blank=True),
        _by("PivotPeriodeZilong", "TGL_ENTRY"),
    ],
    "pivot_template_ming": [
        _with_share("PivotStatusMing", "STATUS_POD"),
        _with_share("PivotRegionalMing", "REGIONAL"),
        _with_share("PivotServiceMing", "SERVICE"),
        _with_share("PivotCarrerMing", "CARRER"),
        _with_share("PivotZonaMing", "ZONA"),
        _by("PivotPeriodeMing", "TGL_ENTRY"),
    ],
    "pivot_regional_3lc_by_status": [_by("PivotRegional3LCByStatus", ["REGIONAL", "3 LC DEST"], "STATUS_POD")],
}
