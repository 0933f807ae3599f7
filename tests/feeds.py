"""Small CSV fixtures in the feed shapes (written as text, like the API does)."""

import os

from meterlake import schemas as S


def periodic_value(name: str, row: int) -> str:
    if name in S.PERIODIC_INT:
        return str(row * 1000 + S.PERIODIC.names.index(name))
    if name in S.PERIODIC_STRING:
        return f"{name}-{row}"
    return f"{row}.{S.PERIODIC.names.index(name):03d}"


def periodic_line(rec_id: int, meter, ts: str, row: int) -> str:
    measures = [periodic_value(n, row) for n in S.periodic_measure_names()]
    return ",".join([str(rec_id), "" if meter is None else str(meter), ts] + measures)


def event_line(meter, event_id, ts: str, row: int) -> str:
    measures = [f"{row}.{i:02d}" for i in range(len(S.EVENT_MEASURES))]
    return ",".join(["" if meter is None else str(meter), "" if event_id is None else str(event_id), ts] + measures)


def registry_line(dev_id) -> str:
    return f"{'' if dev_id is None else dev_id},SN{dev_id},site {dev_id},1,1.5,2.5"


def write_text(path: str, lines) -> str:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + ("\n" if lines else ""))
    return path


def write_day(in_dir, date, devices, periodic_rows, event_rows=None, event_lines=None):
    """periodic_rows: (id, meter, ts, row); event_rows: (meter, event_id, ts, row)."""
    write_text(os.path.join(in_dir, f"{date}_devices.csv"), [",".join(S.REGISTRY.names)] + [registry_line(d) for d in devices])
    write_text(
        os.path.join(in_dir, f"{date}_data.csv"),
        [",".join(S.PERIODIC.names)] + [periodic_line(*r) for r in periodic_rows],
    )
    if event_lines is None:
        event_lines = [",".join(S.EVENT.names)] + [event_line(*r) for r in (event_rows or [])]
    write_text(os.path.join(in_dir, f"{date}_event_data.csv"), event_lines)
