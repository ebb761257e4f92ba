"""Hand-made log days at 5 s cadence, as text files."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

from millrace.plans.heatpump.logs import LOG_COLUMNS

BASE = {
    "version_raw": 9400, "r_version_raw": 3, "bt1_raw": -50, "bt6_raw": 480, "bt7_raw": 450, "bt25_raw": 350, "bt71_raw": 310,
    "bt63_raw": 352, "tot_int_add_raw": 0, "alarm_number_raw": 0, "calc_supply_raw": 340, "degree_minutes_raw": -1500,
    "bt1_average_raw": -52, "relays_pca_base_raw": 7, "compr_freq_calc_raw": 60, "compr_freq_act_raw": 0, "compr_state_raw": 0,
    "compr_protection_mode_raw": 0, "gp12_speed_raw": 0, "gp10_on_off_raw": 1, "eb101_bt3_raw": 320, "eb101_bt12_raw": 400,
    "eb101_bt14_raw": 700, "eb101_bt15_raw": 350, "eb101_bt16_raw": -30, "eb101_bt17_raw": 20, "eb101_bt28_raw": -48,
    "eb101_bp4_raw": 220, "eb101_bp4_adc_raw": 221, "saturation_temp_raw": 99, "sat_temp_sent_raw": 99,
    "eb101_low_pressure_raw": 55, "prio_raw": 30,
}


def line(when: dt.datetime, **registers) -> str:
    values = {**BASE, **registers}
    head = [when.strftime("%Y-%m-%d"), when.strftime("%H:%M:%S")]
    return "\t".join([*head, *[str(values[c]) for c in LOG_COLUMNS[2:]]])


def run(start: str, samples: int, step: int = 5, **registers) -> list[str]:
    t0 = dt.datetime.fromisoformat(start)
    return [line(t0 + dt.timedelta(seconds=step * i), **registers) for i in range(samples)]


HEADERS = ["Divisors\t" + "\t".join(["1"] * 34), "\t".join(["Date", "Time", *LOG_COLUMNS[2:]])]


def write_day(folder: Path, name: str, lines: list[str]) -> None:
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join([*HEADERS, *lines]) + "\n")


ON = {"compr_freq_act_raw": 600, "compr_state_raw": 2}


def day_one() -> list[str]:
    """Runs at the start of the day, around midnight, short, and too short; odd rows."""
    d = "2024-01-10"
    return [
        *run(f"{d} 00:00:00", 12, **ON),  # already running: counts as a start
        *run(f"{d} 00:01:00", 10),
        *run(f"{d} 00:01:50", 6, **ON),  # exactly six samples, off for 50 s: short cycle
        *run(f"{d} 00:02:20", 70),  # off for 350 s
        *run(f"{d} 00:08:10", 5, **ON),  # five samples: no cycle row
        *run(f"{d} 00:08:35", 4),
        # alarms: none, 183, 271, none, 183
        *run(f"{d} 01:00:00", 3, alarm_number_raw=183), *run(f"{d} 01:00:15", 2, alarm_number_raw=271),
        *run(f"{d} 01:00:25", 2), *run(f"{d} 01:00:35", 1, alarm_number_raw=183),
        # defrost: fan 31 counts, 30 does not, fan off does not
        *run(f"{d} 02:00:00", 4, eb101_bt16_raw=150, gp12_speed_raw=31), *run(f"{d} 02:00:20", 2, eb101_bt16_raw=150, gp12_speed_raw=30),
        *run(f"{d} 02:00:30", 2, eb101_bt16_raw=160, gp12_speed_raw=40), *run(f"{d} 02:00:40", 2, eb101_bt16_raw=160),
        # hot water with a rising tank and all heater stages
        *[line(dt.datetime(2024, 1, 10, 3, 0, 5 * i), prio_raw=20, bt6_raw=440 + i, bt7_raw=400 + 2 * i,
               tot_int_add_raw=v, **ON) for i, v in enumerate([0, 300, 600, 900, 450])],
        # rows that rules or header checks remove
        line(dt.datetime(2024, 1, 10, 4), bt1_raw=510), line(dt.datetime(2024, 1, 10, 4, 0, 5), bt25_raw=90),
        line(dt.datetime(2024, 1, 10, 4, 0, 10), compr_freq_act_raw=1310), line(dt.datetime(2024, 1, 10, 4, 0, 15), compr_freq_act_raw=""),
        line(dt.datetime(2024, 1, 10, 4, 0, 20), bt25_raw="x1"),
        "2024-01-10\t99:99:99\t" + "\t".join(str(BASE[c]) for c in LOG_COLUMNS[2:]),
        "2024-01-10\t04:00:25\t9400",  # short row
        line(dt.datetime(2024, 1, 10, 4, 0, 30)) + "\textra\tvalues",  # long row, kept
        *run(f"{d} 23:59:30", 6, **ON),  # crosses midnight: two cycles
    ]


def day_two() -> list[str]:
    d = "2024-01-11"
    return [*run(f"{d} 00:00:00", 8, **ON), *run(f"{d} 00:00:40", 2), *run(f"{d} 00:10:41", 1), *run(f"{d} 00:11:42", 1)]
