"""The rules of cutting, record by record: what the distributed operators are compared with."""


def fold(records, clip_ms, idle_ms=None):
    """``records``: (sequence, offset, length, ts_ms, arrival). Returns (start_ts_ms, offset, length, complete)."""
    clips, held = [], None
    for sequence, offset, length, ts_ms, arrival in records:
        if held and idle_ms is not None and arrival - held["arrival"] >= idle_ms:
            clips.append((*held["clip"], False))
            held = None
        if held and (sequence, offset) != held["next"]:
            clips.append((*held["clip"], False))
            held = None
        elif held and ts_ms - held["clip"][0] >= clip_ms:
            clips.append((*held["clip"], True))
            held = None
        start, first, total = held["clip"] if held else (ts_ms, offset, 0)
        held = {"clip": (start, first, total + length), "next": (sequence + 1, offset + length), "arrival": arrival}
    if held:
        clips.append((*held["clip"], True))
    return clips


def random_records(rnd, count):
    sequence, offset, ts_ms, arrival = rnd.randint(0, 5), 0, rnd.randint(0, 10_000), 0
    breaks, steady, wild = rnd.choice([0, 0, 0.02, 0.3]), rnd.random() < 0.3, rnd.random() < 0.5
    records = []
    for _ in range(count):
        if rnd.random() < breaks:
            sequence += rnd.choice([0, 0, 1, 3])
            offset += rnd.choice([0, 5])
        length = rnd.randint(0, 9)
        records.append((sequence, offset, length, ts_ms, arrival))
        sequence, offset = sequence + 1, offset + length
        steps = [0, 1, 50, 300, 300, 1500, -700, -3000, 6000] if wild else [10, 20, 400]
        ts_ms += 100 if steady else rnd.choice(steps)
        arrival += rnd.choice([1, 5, 50])
    return records
