"""Builders for small sounding files."""

from __future__ import annotations


def header(numlev="2", station="ZZA00012345", year="1954", month="03", day="17", hour="06",
           reltime="1125", p_src="", np_src="own-src1", lat="123456", lon="-7654321"):
    line = (
        f"#{station:<11} {year:>4} {month:>2} {day:>2} {hour:>2} {reltime:>4} {str(numlev):>4} "
        f"{p_src:<8} {np_src:<8} {lat:>7} {lon:>8}"
    )
    assert len(line) == 71
    return line


def level(gph="250", temp="-9999", pflag="", tflag="", wspd="20"):
    line = (
        f"30 {'-9999':>5} {'-9999':>6}{pflag:1}{gph:>5}{'':1}{temp:>5}{tflag:1}{'-9999':>5} "
        f"{'-9999':>5} {'90':>5} {wspd:>5} "
    )
    assert len(line) == 52
    return line


def uid(station="ZZA00012345", year="1954", month="03", day="17", hour="06", reltime="1125"):
    return f"{station}{year}{month}{day}{hour}{reltime}"


def put(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(text.encode())
    return str(folder)
