"""Keyed state for row-ordered logic on streams.

Spark has no row windows on streams, so each symbol keeps a small state: the last rows, the
running averages, or the previous quote. Two modes:

- By arrival (``piece_ms`` None): rows of one trigger are put in event-time order and applied, so a
  task holds a symbol's rows of one trigger. A row that arrives in a later trigger than younger
  rows is applied in order of arrival.
- By event time (``piece_ms``, on a stream with a watermark): rows wait in the state, a piece of
  event time each, until the watermark has passed the piece. Then its rows are sorted and applied,
  those of short pieces together. Rows within the watermark's delay give the table's result whenever
  they arrive, and a task holds an Arrow batch of arriving rows, ``RUN_ROWS`` rows or one longer piece
  of one symbol. The output has ``closed``, the end of a row's piece, as its event time, so that
  further state can follow it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROWS = 51       # frame of the z-scores, current row included
SHORT = 20      # frame of the averages
WINDOWS = 10_000    # frames that are summed at once
RUN_ROWS = 50_000   # rows of passed pieces that are applied together


def _ordered(rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
    return pd.concat(list(rows)).sort_values(["at", "id"], kind="stable", ignore_index=True)


class RowProcessor(StatefulProcessor):
    """Applies a symbol's rows in order. Subclasses open their state in ``open`` and give the
    output of some rows, in order and later than all before, in ``apply``; ``idle`` hears of the
    timers that ``wake`` has set. ``time`` names the column that rows keep as their time: ``at``, in
    microseconds, unless a watermark needs ``ts``, as a timestamp takes Spark's Python worker longer
    to hand over than the rest of the row."""

    COLUMNS = ""
    TYPES = {"at": "bigint", "ts": "timestamp"}

    def __init__(self, piece_ms: int | None = None, carry: tuple[str, ...] = ()) -> None:
        self.piece_ms, self.carry = piece_ms, carry
        self.time = "at" if piece_ms is None else "ts"

    @property
    def output(self) -> str:
        kept = "".join(f"{c} string, " for c in self.carry)
        closed = ", closed timestamp" if self.piece_ms else ""
        return (f"symbol string, id bigint, {self.time} {self.TYPES[self.time]}, price double, "
                f"volume bigint, {kept}{self.COLUMNS}{closed}")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        if self.piece_ms:
            # A piece's parts are entries of their own, so that one more does not write the others again.
            self.parts = handle.getMapState("parts", "piece bigint", "n bigint")
            self.waiting = handle.getMapState("waiting", "piece bigint, part bigint", "rows binary")
        self.open(handle)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if not self.piece_ms:
            yield self._with_head(key, _ordered(rows))
            return
        known = {piece for (piece,) in self.parts.keys()}
        held = {}
        for chunk in rows:
            pieces = (chunk["at"] // (self.piece_ms * 1000)).to_numpy()
            order = np.argsort(pieces, kind="stable")
            batch = pa.RecordBatch.from_pandas(chunk, preserve_index=False).take(pa.array(order))
            found, starts = np.unique(pieces[order], return_index=True)
            for piece, start, end in zip(found.tolist(), starts, [*starts[1:], len(order)]):
                if piece not in held:
                    held[piece] = self.parts.getValue((piece,))[0] if piece in known else 0
                self.waiting.updateValue((piece, held[piece]), (_packed(batch.slice(start, end - start)),))
                held[piece] += 1
        for piece, n in held.items():
            self.parts.updateValue((piece,), (n,))
        if held:
            self._call(min(held))

    def _call(self, piece: int) -> None:
        """One timer, at the end of the first waiting piece: it hears of all that have passed by then."""
        self.handle.registerTimer((piece + 1) * self.piece_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        passed = mark // self.piece_ms
        run, size = [], 0
        for piece, n in sorted((piece, n) for (piece,), (n,) in self.parts.iterator()):
            if piece >= passed:
                self._call(piece)
                break
            for part in range(n):
                run.append(_unpacked(self.waiting.getValue((piece, part))[0]))
                size += run[-1].num_rows
                self.waiting.removeKey((piece, part))
            self.parts.removeKey((piece,))
            if size >= RUN_ROWS:
                yield self._closed(key, run)
                run, size = [], 0
        if run:
            yield self._closed(key, run)
        self.idle(passed * self.piece_ms)

    def _closed(self, key, run: list[pa.Table]) -> pd.DataFrame:
        rows = _ordered([pa.concat_tables(run, promote_options="permissive").to_pandas()])
        ends = (rows["at"] // (self.piece_ms * 1000) + 1) * self.piece_ms
        return self._with_head(key, rows).assign(closed=pd.to_datetime(ends, unit="ms"))

    def _with_head(self, key, new: pd.DataFrame) -> pd.DataFrame:
        head = pd.DataFrame({"symbol": key[0], **{
            c: new[c] for c in ("id", self.time, "price", "volume", *self.carry)}})
        return pd.concat([head, self.apply(new)], axis=1)

    def wake(self, at_ms: int) -> None:
        self.handle.registerTimer(at_ms)

    def idle(self, due: int) -> None:
        pass

    def close(self) -> None:
        pass


def _packed(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pa.Table:
    """Without the notes on pandas types, which differ between parts with and without nulls."""
    return pa.ipc.open_stream(bytes(data)).read_all().replace_schema_metadata(None)


def _moments(values: pd.Series, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean, sample deviation and flatness of the last ``size`` values up to each row, without nulls.

    Each window is summed by itself: sums that move with the window keep the rounding of values that
    have left it, which shows where the rest is nearly flat.
    """
    padded = np.concatenate([np.full(size - 1, np.nan), values.to_numpy(dtype="float64")])
    windows = np.lib.stride_tricks.sliding_window_view(padded, size)
    mean, deviation, flat = np.empty(len(values)), np.empty(len(values)), np.empty(len(values), bool)
    with np.errstate(divide="ignore", invalid="ignore"):
        for start in range(0, len(values), WINDOWS):
            at = slice(start, start + WINDOWS)
            part = windows[at]
            there = ~np.isnan(part)
            n = there.sum(axis=1)
            mean[at] = np.where(there, part, 0.0).sum(axis=1) / n
            off = np.where(there, part - mean[at, None], 0.0)
            deviation[at] = np.sqrt((off * off).sum(axis=1) / (n - 1))
            flat[at] = off.max(axis=1, initial=-np.inf, where=there) == off.min(
                axis=1, initial=np.inf, where=there)
    return mean, deviation, flat


class RollingProcessor(RowProcessor):
    """Indicators over 20 rows and z-scores over 51, from one ring buffer per symbol. ``carry``
    names text columns that rows keep."""

    COLUMNS = ("price_change double, price_change_pct double, sma_20 double, "
               "volatility double, volume_sma double, price_zscore double, "
               "volume_zscore double, is_anomaly boolean, anomaly_severity string")

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.past = handle.getListState("past", "price double, volume double")

    def apply(self, new: pd.DataFrame) -> pd.DataFrame:
        old = pd.DataFrame(list(self.past.get()), columns=["price", "volume"], dtype="float64")
        both = pd.concat([old, new[["price", "volume"]].astype("float64")], ignore_index=True)
        price, volume = both["price"], both["volume"]
        sma, volatility, _ = _moments(price, SHORT)
        volume_sma, _, _ = _moments(volume, SHORT)
        before = price.shift(1)
        change = price - before
        pz, vz = self._z(price), self._z(volume)
        out = pd.DataFrame({
            "price_change": change,
            "price_change_pct": np.where(before > 0, change / before * 100, 0.0),
            "sma_20": sma, "volatility": volatility, "volume_sma": volume_sma,
            "price_zscore": pz, "volume_zscore": vz,
            "is_anomaly": (pz.abs() > 3) | (vz.abs() > 3),
            "anomaly_severity": np.select(
                [pz.abs() > 5, pz.abs() > 3, vz.abs() > 3], ["CRITICAL", "HIGH", "MEDIUM"],
                "LOW")}).iloc[len(old):].reset_index(drop=True)
        self.past.put(list(both.tail(ROWS - 1).itertuples(index=False, name=None)))
        return out

    @staticmethod
    def _z(values: pd.Series) -> pd.Series:
        mean, deviation, flat = _moments(values, ROWS)
        # A flat window has a deviation that is zero up to rounding.
        return ((values - mean) / deviation).where(~flat)


class EmaProcessor(RowProcessor):
    """Running averages and MACD; the state is three numbers per symbol."""

    COLUMNS = ("ema_12 double, ema_26 double, macd_line double, signal_line double, "
               "macd_histogram double")

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "fast double, slow double, signal double")

    @staticmethod
    def _run(values: np.ndarray, seed: float | None, period: int) -> np.ndarray:
        series = pd.Series(values if seed is None else np.concatenate([[seed], values]))
        out = series.ewm(span=period, adjust=False).mean().to_numpy()
        return out if seed is None else out[1:]

    def apply(self, new: pd.DataFrame) -> pd.DataFrame:
        fast, slow, signal = self.last.get() if self.last.exists() else (None, None, None)
        price = new["price"].to_numpy(dtype="float64")
        e12, e26 = self._run(price, fast, 12), self._run(price, slow, 26)
        line = e12 - e26
        sig = self._run(line, signal, 9)
        self.last.update((float(e12[-1]), float(e26[-1]), float(sig[-1])))
        return pd.DataFrame({"ema_12": e12, "ema_26": e26, "macd_line": line, "signal_line": sig,
                             "macd_histogram": line - sig})


class PreviousQuoteProcessor(RowProcessor):
    """Previous price and volume of a symbol. With ``keep_ms`` a quote that comes more than that
    after the last one, by event time, has no previous one; by event time the forgotten state is
    removed by a timer, by arrival it stays until the symbol's next quote."""

    COLUMNS = "previous_price double, previous_volume double"

    def __init__(self, keep_ms: int | None = None, piece_ms: int | None = None,
                 carry: tuple[str, ...] = ()) -> None:
        super().__init__(piece_ms, carry)
        self.keep_ms = keep_ms

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "price double, volume double, at bigint")

    def apply(self, new: pd.DataFrame) -> pd.DataFrame:
        price, volume, at = self.last.get() if self.last.exists() else (None, None, None)
        past = new[["price", "volume", "at"]].astype({"price": "float64", "volume": "float64"}).shift(1)
        past = past.astype({"at": "Int64"})
        past.loc[0] = [price, volume, at]
        last_at = int(new["at"].iloc[-1])
        self.last.update((float(new["price"].iloc[-1]), float(new["volume"].iloc[-1]), last_at))
        if self.keep_ms is not None:
            late = (new["at"] - past["at"] > self.keep_ms * 1000).fillna(True)
            past.loc[late, ["price", "volume"]] = np.nan
            if self.piece_ms:  # at a piece's end, so that rows that wait come first
                self.wake((self._forgotten(last_at) // self.piece_ms + 1) * self.piece_ms)
        return pd.DataFrame({"previous_price": past["price"].astype("float64"),
                             "previous_volume": past["volume"].astype("float64")})

    def _forgotten(self, at: int) -> int:
        """The first millisecond at which a quote would come too late."""
        return at // 1000 + self.keep_ms + 1

    def idle(self, due: int) -> None:
        if self.keep_ms is not None and self.last.exists():
            at = self.last.get()[2]
            if self._forgotten(at) <= due:
                self.last.clear()


def _stateful(stream: DataFrame, processor: RowProcessor, watermarked: bool = False) -> DataFrame:
    by_time = processor.piece_ms is not None
    if watermarked:
        processor.time = "ts"
    rows = stream.select("symbol", "id", "ts", "price", "volume", *processor.carry,
                         F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))
    if by_time:
        rows = rows.filter(F.col("ts").isNotNull())  # no watermark would ever pass them
    if processor.time == "at":
        rows = rows.drop("ts")
    out = rows.groupBy("symbol").transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=processor.output, outputMode="Append",
        timeMode="EventTime" if by_time or watermarked else "None",
        eventTimeColumnName="closed" if by_time else "ts" if watermarked else "")
    if processor.time == "ts":
        return out
    return out.select(*[F.timestamp_micros(c).alias("ts") if c == "at" else c for c in out.columns])


def stream_rolling(stream: DataFrame, carry: tuple[str, ...] = (), watermarked: bool = False,
                   piece_ms: int | None = None) -> DataFrame:
    """Indicators and z-scores of each row. With ``watermarked`` (the stream has a watermark on
    ``ts``) the result has one too, so that time windows can follow; later rows are left out."""
    return _stateful(stream, RollingProcessor(piece_ms, carry), watermarked)


def stream_ema(stream: DataFrame, piece_ms: int | None = None) -> DataFrame:
    return _stateful(stream, EmaProcessor(piece_ms))


def stream_previous_quote(stream: DataFrame, keep_ms: int | None = None,
                          piece_ms: int | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    return _stateful(stream, PreviousQuoteProcessor(keep_ms, piece_ms, carry))
