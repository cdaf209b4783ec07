"""Writes small NetCDF-4-like HDF5 files by the published format, in its older form (symbol tables, version 1 headers) and its newer one."""

import struct
import zlib

import numpy as np

NOWHERE = (1 << 64) - 1


class Writer:
    def __init__(self, new=False, dense=False, fletcher=False):
        self.out, self.new, self.dense, self.fletcher = bytearray(96), new, dense, fletcher

    def put(self, raw):
        self.out += bytes(-len(self.out) % 8)
        at = len(self.out)
        self.out += raw
        return at

    @staticmethod
    def dtype(dt):
        dt = np.dtype(dt)
        order = int(dt.str[0] == ">")
        if dt.kind == "f":
            props = struct.pack("<HHBBBBI", 0, 8 * dt.itemsize, *((23, 8, 0, 23, 127) if dt.itemsize == 4 else (52, 11, 0, 52, 1023)))
            return bytes([0x11, 0x20 | order, dt.itemsize * 8 - 1, 0]) + struct.pack("<I", dt.itemsize) + props
        return bytes([0x10, order | (8 if dt.kind == "i" else 0), 0, 0]) + struct.pack("<IHH", dt.itemsize, 0, 8 * dt.itemsize)

    def space(self, shape):
        head = bytes([2, len(shape), 0, 1 if shape else 0]) if self.new else bytes([1, len(shape), 0, 0, 0, 0, 0, 0])
        return head + b"".join(struct.pack("<Q", n) for n in shape)

    def attribute(self, name, value):
        if isinstance(value, str):
            raw, kind, shape = value.encode() + b"\0", bytes([0x13, 0, 0, 0]) + struct.pack("<I", len(value) + 1), ()
        else:
            value = np.asarray(value)
            raw, kind, shape = value.tobytes(), self.dtype(value.dtype), value.shape
        name, space = name.encode() + b"\0", self.space(shape)
        pad = (lambda b: b) if self.new else (lambda b: b + bytes(-len(b) % 8))
        return bytes([3 if self.new else 1, 0]) + struct.pack("<HHH", len(name), len(kind), len(space)) + (b"\0" if self.new else b"") + pad(name) + pad(kind) + pad(space) + raw

    def header(self, messages, split=False):
        """An object header; with `split`, its last messages stand in a continuation."""
        if not self.new:
            packed = [struct.pack("<HHB3x", t, len(b) + -len(b) % 8, 0) + b + bytes(-len(b) % 8) for t, b in messages]
            if split:
                rest = b"".join(packed[-2:])
                at = self.put(rest)
                packed = [*packed[:-2], struct.pack("<HHB3xQQ", 0x10, 16, 0, at, len(rest))]
            body = b"".join(packed)
            return self.put(struct.pack("<BBHIII", 1, 0, len(messages), 1, len(body), 0) + body)
        packed = [struct.pack("<BHBH", t, len(b), 0, 0) + b for t, b in messages]
        if split:
            rest = b"OCHK" + b"".join(packed[-2:]) + bytes(4)
            at = self.put(rest)
            packed = [*packed[:-2], struct.pack("<BHBHQQ", 0x10, 16, 0, 0, at, len(rest))]
        body = b"".join(packed)
        return self.put(b"OHDR" + bytes([2, 0x04 | 0x20 | 2]) + bytes(16) + struct.pack("<I", len(body)) + body + bytes(4))

    def heap(self, objects, kind):
        """A fractal heap and its name index: (heap address, tree address). Links are kind 5, attributes kind 8."""
        bits, offset_bytes = (32, 4) if kind == 5 else (40, 5)
        width, first, largest = 4, 512, 65536
        # Objects fill blocks of an indirect root, or one direct root block if they fit.
        sizes, blocks, where = [first] * 8 + [first * 2] * 4 + [first * 4] * 4, [], []
        head = 13 + offset_bytes + 4
        for raw in objects:
            if not blocks or len(blocks[-1]) + len(raw) > sizes[len(blocks) - 1]:
                while True:
                    blocks.append(bytearray(head))
                    if head + len(raw) <= sizes[len(blocks) - 1]:
                        break
            where.append((sum(sizes[: len(blocks) - 1]) + len(blocks[-1]), len(raw)))
            blocks[-1] += raw
        direct = [self.put(b"FHDB" + bytes(b)[4:] + bytes(n - len(b))) for b, n in zip(blocks, sizes, strict=False)]
        rows = 0 if len(direct) == 1 else -(-len(direct) // width)
        root = direct[0]
        if rows:
            entries = direct + [NOWHERE] * (rows * width - len(direct))
            root = self.put(b"FHIB" + bytes(1 + 8 + offset_bytes) + b"".join(struct.pack("<Q", a) for a in entries) + bytes(4))
        heap = self.put(b"FRHP" + bytes([0]) + struct.pack("<HHBI", 7 if kind == 5 else 8, 0, 0, 4096) + bytes(96) + struct.pack("<HQQHHQH", width, first, largest, bits, 1, root, rows) + bytes(4))
        numbers = [bytes([0]) + at.to_bytes(offset_bytes, "little") + n.to_bytes(2, "little") for at, n in where]
        records = [bytes(4) + n if kind == 5 else n + bytes(9) for n in numbers]
        size, w = 512, len(records[0])
        most = (size - 10) // w
        leaf = lambda rs: self.put((b"BTLF" + bytes([0, kind]) + b"".join(rs)).ljust(size, b"\0"))
        if len(records) <= most:
            depth, top, n = 0, leaf(records), len(records)
        else:
            parts = [records[i : i + most] for i in range(0, len(records), most + 1)]
            own = [records[i] for i in range(most, len(records), most + 1)]
            parts += [[]] * (len(own) + 1 - len(parts))
            children = b"".join(struct.pack("<QB", leaf(p), len(p)) for p in parts)
            depth, n = 1, len(own)
            top = self.put((b"BTIN" + bytes([0, kind]) + b"".join(own) + children).ljust(size, b"\0"))
        tree = self.put(b"BTHD" + bytes([0, kind]) + struct.pack("<IHHBBQHQ", size, w, depth, 100, 40, top, n, len(records)) + bytes(4))
        return heap, tree

    def chunks(self, values, chunk, filtered, leave_out=(), fan=3):
        """Chunks and a B-tree over them with `fan` entries a node."""
        rank, starts = values.ndim, [()]
        for n, c in zip(values.shape, chunk, strict=True):
            starts = [(*s, i) for s in starts for i in range(0, n, c)]
        entries = []
        for s in starts:
            if s in leave_out:
                continue
            block = np.zeros(chunk, dtype=values.dtype)
            part = values[tuple(slice(a, a + c) for a, c in zip(s, chunk, strict=True))]
            block[tuple(slice(0, n) for n in part.shape)] = part
            raw = block.tobytes()
            if filtered:
                raw = np.frombuffer(raw, np.uint8).reshape(-1, values.dtype.itemsize).T.tobytes()
                raw = zlib.compress(raw)
            if self.fletcher:
                raw += b"sum!"
            entries.append((struct.pack("<II", len(raw), 0) + struct.pack(f"<{rank}Q", *s) + bytes(8), self.put(raw)))
        end = struct.pack("<II", 0, 0) + struct.pack(f"<{rank}Q", *(n + -n % c for n, c in zip(values.shape, chunk, strict=True))) + bytes(8)
        level = 0
        while True:
            nodes = []
            for i in range(0, len(entries), fan):
                some = entries[i : i + fan]
                last = entries[i + fan][0] if i + fan < len(entries) else end
                nodes.append((some[0][0], self.put(b"TREE" + struct.pack("<BBHQQ", 1, level, len(some), NOWHERE, NOWHERE) + b"".join(k + struct.pack("<Q", a) for k, a in some) + last)))
            if len(nodes) <= 1:
                return nodes[0][1] if nodes else NOWHERE
            entries, level = nodes, level + 1

    def dataset(self, values, attrs, chunk=None, filtered=False, fill=None, leave_out=(), inline=False):
        values = np.asarray(values)
        messages = [(0x01, self.space(values.shape)), (0x03, self.dtype(values.dtype))]
        if fill is not None:
            raw = np.array(fill, values.dtype).tobytes()
            messages.append((0x05, (bytes([3, 0x20 | 9]) if self.new else bytes([2, 1, 0, 1])) + struct.pack("<I", len(raw)) + raw))
        if chunk:
            tree = self.chunks(values, chunk, filtered, leave_out)
            ids = [2, 1] * filtered + [3] * self.fletcher
            if ids:
                given = {2: [values.dtype.itemsize], 1: [4], 3: []}
                if self.new:
                    body = bytes([2, len(ids)]) + b"".join(struct.pack("<HHH", i, 0, len(given[i])) + b"".join(struct.pack("<I", x) for x in given[i]) for i in ids)
                else:
                    names = {2: b"shuffle\0", 1: b"deflate\0", 3: b"fletcher32\0\0\0\0\0\0"}
                    body = bytes([1, len(ids)]) + bytes(6) + b"".join(struct.pack("<HHHH", i, len(names[i]), 0, len(given[i])) + names[i] + b"".join(struct.pack("<I", x) for x in given[i]) + bytes(4 * (len(given[i]) % 2)) for i in ids)
                messages.append((0x0B, body))
            messages.append((0x08, bytes([3, 2, values.ndim + 1]) + struct.pack("<Q", tree) + b"".join(struct.pack("<I", c) for c in (*chunk, values.dtype.itemsize))))
        elif inline:
            messages.append((0x08, bytes([3, 0]) + struct.pack("<H", values.nbytes) + values.tobytes()))
        else:
            messages.append((0x08, bytes([3, 1]) + struct.pack("<QQ", self.put(values.tobytes()), values.nbytes)))
        bodies = [self.attribute(k, v) for k, v in attrs.items()]
        if self.dense and bodies:
            messages.append((0x15, bytes([0, 1]) + struct.pack("<H", len(bodies)) + struct.pack("<QQ", *self.heap(bodies, 8))))
        else:
            messages += [(0x0C, b) for b in bodies]
        return self.header(messages, split=len(messages) > 5)

    def file(self, datasets):
        """datasets: name -> object header."""
        names = sorted(datasets)
        if self.new:
            link = lambda n: bytes([1, 0x04]) + bytes(8) + bytes([len(n)]) + n.encode() + struct.pack("<Q", datasets[n])
            if self.dense:
                messages = [(0x02, bytes([0, 1]) + bytes(8) + struct.pack("<QQ", *self.heap([link(n) for n in names], 5)))]
            else:
                messages = [(0x02, bytes([0, 1]) + bytes(8) + struct.pack("<QQ", NOWHERE, NOWHERE)), *((0x06, link(n)) for n in names)]
            root = self.header(messages)
            self.out[:48] = b"\x89HDF\r\n\x1a\n" + bytes([2, 8, 8, 0]) + struct.pack("<QQQQ", 0, NOWHERE, len(self.out), root) + bytes(4)
            return bytes(self.out)
        text, at = bytearray(8), {}
        for n in names:
            at[n] = len(text)
            text += n.encode() + b"\0" + bytes(-(len(n) + 1) % 8)
        data = self.put(bytes(text))
        heap = self.put(b"HEAP" + bytes(4) + struct.pack("<QQQ", len(text), NOWHERE, data))
        symbols, entries = lambda ns: self.put(b"SNOD" + struct.pack("<BBH", 1, 0, len(ns)) + b"".join(struct.pack("<QQ24x", at[n], datasets[n]) for n in ns)), []
        for i in range(0, len(names), 3):
            entries.append((at[names[min(i + 2, len(names) - 1)]], symbols(names[i : i + 3])))
        tree = self.put(b"TREE" + struct.pack("<BBHQQQ", 0, 0, len(entries), NOWHERE, NOWHERE, 0) + b"".join(struct.pack("<QQ", a, k) for k, a in entries))
        root = self.header([(0x11, struct.pack("<QQ", tree, heap))])
        self.out[:96] = b"\x89HDF\r\n\x1a\n" + bytes([0, 0, 0, 0, 0, 8, 8, 0]) + struct.pack("<HHI", 4, 16, 0) + struct.pack("<QQQQ", 0, NOWHERE, len(self.out), NOWHERE) + struct.pack("<QQII16x", 0, root, 0, 0)
        return bytes(self.out)


def netcdf4(values, lat, lon, times, chunk, variable="tas", attrs=(), new=False, dense=False, filtered=True, fletcher=False, fill=None, leave_out=(), others=0):
    """A grid file's bytes."""
    w = Writer(new, dense, fletcher)
    held = {"lat": w.dataset(np.asarray(lat, "<f8"), {"units": "degrees_north"}), "lon": w.dataset(np.asarray(lon, "<f8"), {"units": "degrees_east"}, inline=True)}
    held["time"] = w.dataset(np.asarray(times, "<f8"), {"units": "days since 1850-01-01", "calendar": "noleap"}, chunk=(2,), filtered=filtered)
    held[variable] = w.dataset(values, dict(attrs), chunk=chunk, filtered=filtered, fill=fill, leave_out=leave_out)
    for i in range(others):
        held[f"other_{i:03d}"] = w.dataset(np.zeros(2, "<i4"), {})
    return w.file(held)
