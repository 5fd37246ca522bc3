"""Writes small feeds in the text format, as folders or zips."""

import io
import zipfile
from pathlib import Path

ARITY = {
    "1.9": dict(Dopravci=12, Altdop=13, Caskody=8, Pevnykod=3, Linky=10, Spoje=12, Zastavky=12, Zasspoje=10),
    "1.10": dict(
        Dopravci=13, Altdop=15, Caskody=9, Pevnykod=3, Linky=16, Spoje=14, Zastavky=12,
        Zasspoje=12, Oznacniky=7,
    ),
    "1.11": dict(
        Dopravci=13, Altdop=15, Caskody=9, Pevnykod=3, Linky=17, Spoje=14, Zastavky=12,
        Zasspoje=15, Oznacniky=7,
    ),
}
ARITY["1.8"] = ARITY["1.9"]


def record(fields):
    return ",".join('"' + str(f).replace('"', '""') + '"' for f in fields) + ";\r\n"


def padded(values, size):
    """Fields of one record from {position: value}."""
    fields = [""] * size
    for position, value in values.items():
        fields[position] = value
    return fields


def feed(version="1.11", lines=None, trips=None, calls=None, stops=None, carriers=None, codes=None, alternatives=None, fixed=None):
    """File contents of one feed with sensible defaults; all values are lists of records."""
    a = ARITY[version]
    new, newest = version in ("1.10", "1.11"), version == "1.11"

    def line(number="100001", name="Město - Vesnice", ico="00012345", frm="01012024", to="31122024", vehicle="A", discr="1"):
        v = {0: number, 1: name, 2: ico, 3: "B"}
        if not new:
            v |= {5: "L1", 6: "01012020", 7: "31122030", 8: frm, 9: to}
        elif not newest:
            v |= {4: vehicle, 5: "0", 6: "0", 7: "1", 9: "L1", 10: "01012020", 11: "31122030", 12: frm, 13: to, 14: "1", 15: discr}
        else:
            v |= {4: vehicle, 5: "0", 6: "1", 7: "0", 8: "1", 10: "L1", 11: "01012020", 12: "31122030", 13: frm, 14: to, 15: "1", 16: discr}
        return padded(v, a["Linky"])

    def trip(line="100001", number="1", codes=("1",), discr="1", group=""):
        v = {0: line, 1: number, **{2 + i: c for i, c in enumerate(codes)}}
        if new:
            v |= {12: group, 13: discr}
        return padded(v, a["Spoje"])

    def call(line="100001", trip="1", tariff="1", stop="1", km="0", arrival="", departure="", discr="1", post="", amin="", dmax=""):
        v = {0: line, 1: trip, 2: tariff, 3: stop}
        if not new:
            v |= {7: km, 8: arrival, 9: departure}
        elif not newest:
            v |= {4: post, 8: km, 9: arrival, 10: departure, 11: discr}
        else:
            v |= {4: post, 9: km, 10: arrival, 11: departure, 12: amin, 13: dmax, 14: discr}
        return padded(v, a["Zasspoje"])

    def carrier(ico="00012345", name="Žlutý bus", seat="Ostrava", discr="1", www="www.zluty.example"):
        v = {0: ico, 2: name, 5: seat, 6: "123", 10: "info@zluty.example", 11: www}
        if new:
            v[12] = discr
        return padded(v, a["Dopravci"])

    def stop(number="1", town="Ostrava", part="Poruba", place="Vřesinská"):
        return padded({0: number, 1: town, 2: part, 3: place, 5: "CZ"}, a["Zastavky"])

    def code(line="100001", trip="1", kind="1", frm="", to=""):
        return padded({0: line, 1: trip, 2: "1", 4: kind, 5: frm, 6: to}, a["Caskody"])

    def alternative(line="100001", trip="1", ico="00012345", discr="1"):
        v = {0: line, 1: trip, 2: ico}
        if new:
            v[13] = discr
        return padded(v, a["Altdop"])

    build = lambda make, rows: [r if isinstance(r, list) else make(**r) for r in rows]
    files = {
        "VerzeJDF.txt": [[version, "", "", "", ""]],
        "Dopravci.txt": build(carrier, carriers if carriers is not None else [{}]),
        "Linky.txt": build(line, lines if lines is not None else [{}]),
        "Spoje.txt": build(trip, trips if trips is not None else [{}]),
        "Zastavky.txt": build(stop, stops if stops is not None else [{}, {"number": "2", "place": "Hlavní, \"u mostu\""}]),
        "Zasspoje.txt": build(
            call,
            calls
            if calls is not None
            else [{"departure": "0800"}, {"tariff": "2", "stop": "2", "km": "5", "arrival": "0810"}],
        ),
        "Pevnykod.txt": fixed if fixed is not None else [["1", "X", ""], ["2", "+", ""], ["3", "6", ""]],
    }
    if codes:
        files["Caskody.txt"] = build(code, codes)
    if alternatives:
        files["Altdop.txt"] = build(alternative, alternatives)
    return {name: "".join(map(record, rows)).encode("cp1250") for name, rows in files.items()}


def write_folder(root: Path, name: str, files) -> None:
    folder = root / name
    folder.mkdir(parents=True)
    for file, content in files.items():
        (folder / file).write_bytes(content)


def zipped(files) -> bytes:
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        for file, content in files.items():
            archive.writestr(file, content)
    return buffer.getvalue()


def write_zip(root: Path, name: str, files) -> None:
    root.mkdir(parents=True, exist_ok=True)
    (root / name).write_bytes(zipped(files))
