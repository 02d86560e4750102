"""Conversation structure repair by Hirschberg's divide and conquer.

A repaired conversation's role initials read `(s?(ua)+)?`. That language has four states:
nothing yet, after the system turn, after a user, after an assistant. Edits: Keep (0),
Rerole to user or assistant (3), Delete (4; blank and duplicate turns must go), Insert an
empty user or assistant turn (3); a truncated turn that stays adds 3. The cheapest edits
are found half by half: a forward cost vector of the four states up to the middle and a
backward one from the end meet there, the crossings of least total are kept, the left half
is solved towards them and the right half from the one that its edits reach. Among equal
costs the edits whose initials are least in ASCII win. That is right half by half: two
equally cheap strings of edits over the same turns are never one the beginning of the
other, as more letters mean more insertions and each has a price.

Spark sorts a conversation's turns in its partition; a task reads them as a stream. Of a
long conversation it holds two bytes and a digest per turn; texts beyond SPOOL_BYTES lie in a
temporary file of the task until they are written out repaired. One conversation is one
task's work, since its result is one digest over its whole text in order.

Null role or text is one space, null conv_id is a conversation of its own, null turns come
first, turns of equal number follow by role and text. A turn's first fault counts: blank,
duplicate (role and text seen earlier), truncated (last character that is no space not one
of `.!?`). Other columns are dropped, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = " \t\n\v\f\r"
RETITLE, DELETE, INSERT, CUT = 3, 4, 3, 3
FAULTS = ("", "blank", "duplicate", "truncated")
ROLES = {"user": 1, "assistant": 2}
SPOOL_BYTES = 8 << 20
OUT_ROWS = 256

# --- cheapest edits -------------------------------------------------------

#: States. From each but USER a user turn leads to USER, from USER an assistant turn to ASSISTANT.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NEVER = 1 << 60
#: Cost to end well from each state after the last turn, and what is inserted there.
ENDS, TAILS = (0, 2 * INSERT, INSERT, 0), ("", "II", "I", "")


def _prices(initial: str, fault: int) -> tuple[int, int, int, int]:
    """(rerole, keep as system, keep as user, keep as assistant); NEVER where not allowed."""
    if fault in (1, 2):
        return NEVER, NEVER, NEVER, NEVER
    cut = CUT if fault == 3 else 0
    return RETITLE + cut, *(cut if initial == known else NEVER for known in "sua")


def forward(turns, lo: int, hi: int, state: int) -> list[int]:
    """Least cost to be in each state after turns lo to hi, from one state before them."""
    cost = [NEVER] * 4
    cost[state] = 0
    for i in range(lo, hi):
        rerole, system, user, assistant = turns[i]
        a, b, c, d = cost
        c = min(c, min(a, b, d) + INSERT)
        d = min(d, c + INSERT)
        cost = [a + DELETE, min(b + DELETE, a + system), min(c + DELETE, min(a, b, d) + min(rerole, user)),
                min(d + DELETE, c + min(rerole, assistant))]
    return cost


def backward(turns, lo: int, hi: int, ends) -> list[int]:
    """Least cost from each state before turns lo to hi to their end and beyond, by `ends`."""
    cost = list(ends)
    for i in range(hi - 1, lo - 1, -1):
        rerole, system, user, assistant = turns[i]
        a, b, c, d = cost
        to_user = c + min(rerole, user)
        after = [min(a + DELETE, b + system, to_user), min(b + DELETE, to_user),
                 min(c + DELETE, d + min(rerole, assistant)), min(d + DELETE, to_user)]
        c = min(after[USER], after[ASSISTANT] + INSERT)
        cost = [min(after[NOTHING], c + INSERT), min(after[SYSTEM], c + INSERT), c, min(after[ASSISTANT], c + INSERT)]
    return cost


def _one(turn, state: int, ends) -> tuple[str, int]:
    """The edits of one turn, insertions before it first, and the state after it."""
    rerole, system, user, assistant = turn
    found, inserted = [], 0
    while inserted < 4:
        letters, paid = "I" * inserted, INSERT * inserted
        turned = ASSISTANT if state == USER else USER
        keep = assistant if state == USER else user
        found += [(paid + DELETE + ends[state], letters + "D", state),
                  (paid + keep + ends[turned], letters + "K", turned),
                  (paid + rerole + ends[turned], letters + "R", turned)]
        if state == NOTHING:
            found.append((paid + system + ends[SYSTEM], letters + "K", SYSTEM))
        inserted, state = inserted + 1, turned
    _, letters, state = min(found)
    return letters, state


def _between(turns, lo: int, hi: int, state: int, ends) -> tuple[str, int]:
    if hi - lo == 1:
        return _one(turns[lo], state, ends)
    middle = (lo + hi) // 2
    there, back = forward(turns, lo, middle, state), backward(turns, middle, hi, ends)
    least = min(x + y for x, y in zip(there, back))
    crossings = [y if x + y == least else NEVER for x, y in zip(there, back)]
    left, reached = _between(turns, lo, middle, state, crossings)
    right, last = _between(turns, middle, hi, reached, ends)
    return left + right, last


def edits(turns) -> str:
    """The audit: initials of the cheapest edits of turns given by their prices."""
    if not turns:
        return ""
    letters, state = _between(turns, 0, len(turns), NOTHING, ENDS)
    return letters + TAILS[state]


# --- conversations --------------------------------------------------------

def fault_of(role: str, text: str, seen: set[bytes]) -> int:
    """The first fault of a turn; `seen` takes its digest."""
    digest = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
    again = digest in seen
    seen.add(digest)
    shown = text.rstrip(SPACES)
    return 1 if not shown else 2 if again else 0 if shown[-1] in ".!?" else 3


class _Turns:
    """The turns of one conversation: codes in memory, the texts in a spool."""

    def __init__(self, conv):
        self.conv, self.codes, self.seen = conv, [], set()
        self.spool = tempfile.SpooledTemporaryFile(max_size=SPOOL_BYTES)

    def add(self, turn, role: str, text: str) -> None:
        fault = fault_of(role, text, self.seen)
        self.codes.append(_CODES[(role[:1] if role[:1] in ("s", "u", "a") else "", fault)])
        for part in (role.encode(), text.encode(), b"" if turn is None else str(turn).encode()):
            self.spool.write(len(part).to_bytes(8, "little") + part)

    def _part(self) -> bytes:
        return self.spool.read(int.from_bytes(self.spool.read(8), "little"))

    def repaired(self) -> Iterator[tuple]:
        """(conv, place, edit, turn, fault, from_role, role, text) of each edit in order."""
        audit = edits([_PRICES[code] for code in self.codes])
        self.spool.seek(0)
        state, nth = NOTHING, 0
        for place, edit in enumerate(audit):
            turned = ("assistant", ASSISTANT) if state == USER else ("user", USER)
            if edit == "I":
                yield self.conv, place, edit, None, None, None, turned[0], ""
                state = turned[1]
                continue
            old, text, turn = self._part().decode(), self._part().decode(), self._part()
            fault, nth = FAULTS[self.codes[nth] % 4] or None, nth + 1
            role = None if edit == "D" else turned[0] if edit == "R" else old
            yield self.conv, place, edit, int(turn) if turn else None, fault, old, role, None if edit == "D" else text
            if edit == "K":
                state = SYSTEM if old[:1] == "s" else turned[1]
            elif edit == "R":
                state = turned[1]
        self.spool.close()


#: A turn's code is 4 times its initial's number plus its fault.
_CODES = {(initial, fault): 4 * i + fault for i, initial in enumerate(("", "s", "u", "a")) for fault in range(4)}
_PRICES = {code: _prices(*kind) for kind, code in _CODES.items()}
LOG = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("turn", pa.int64()),
                 ("fault", pa.string()), ("from_role", pa.string()), ("role", pa.string()), ("text", pa.string())])
SUMMARY = pa.schema([("conv_id", pa.int64()), *[(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                     ("audit", pa.string()), ("repaired_sha256", pa.string())])


def _sql_schema(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {'long' if f.type == pa.int64() else 'string'}" for f in schema)


def _batches(rows: Iterator[tuple], schema: pa.Schema, most_chars: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += len(row[-1] or "")
        if len(held) >= OUT_ROWS or chars >= most_chars:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _rows(batches) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def repair(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per edit: conv_id, place, edit, turn, fault, from_role, and the role and text that stay.

    Deleted turns have no role and text, inserted ones no turn and from_role. The repaired
    conversation is the rows with a role by place; a conversation's rows lie together in order.
    """
    def filled(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    turns = conversations.select(
        F.col(conv).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        filled(role).alias("role"), filled(text).alias("text"))
    ordered = turns.repartition("conv_id").sortWithinPartitions(
        F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "text")

    def run(batches):
        def edited():
            current = None
            for conv_id, number, who, said in _rows(batches):
                if current is None or current.conv != conv_id:
                    if current is not None:
                        yield from current.repaired()
                    current = _Turns(conv_id)
                current.add(number, who, said)
            if current is not None:
                yield from current.repaired()

        yield from _batches(edited(), LOG)

    return ordered.mapInArrow(run, _sql_schema(LOG))


class _Tally:
    """The figures of one conversation, from its edits in order."""

    def __init__(self, conv):
        self.conv, self.turns, self.first, self.last = conv, 0, None, None
        self.faults, self.illegal, self.cost, self.audit = dict.fromkeys(FAULTS[1:], 0), 0, 0, []
        self.before, self.digest, self.started = None, hashlib.sha256(), False

    def add(self, edit, turn, fault, old, role, text) -> None:
        self.audit.append(edit)
        self.cost += {"K": 0, "R": RETITLE, "D": DELETE, "I": INSERT}[edit]
        if edit != "I":
            if turn is not None and turn != self.last:
                self.turns, self.last = self.turns + 1, turn
                self.first = turn if self.first is None else self.first
            if fault:
                self.faults[fault] += 1
                self.cost += CUT if fault == "truncated" and edit != "D" else 0
            if self.before is not None and self.before + old[:1] not in ("su", "ua", "au"):
                self.illegal += 1
            self.before = old[:1]
        if role is not None:
            self.digest.update(f"{'\n' if self.started else ''}{role}:{text}".encode())
            self.started = True

    def row(self) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return self.conv, gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.audit), self.digest.hexdigest()


def summary(log: DataFrame) -> DataFrame:
    """Figures, audit and digest of each conversation in the rows of `repair`, as it returns them.

    gaps: turn numbers missing between the least and the greatest. illegal: neighbouring
    roles before the repair whose initials are not su, ua or au. repaired_sha256: of the
    repaired `role:text` lines.
    """
    columns = log.select("conv_id", "edit", "turn", "fault", "from_role", "role", "text")

    def run(batches):
        def tallied():
            current = None
            for conv_id, *edit in _rows(batches):
                if current is None or current.conv != conv_id:
                    if current is not None:
                        yield current.row()
                    current = _Tally(conv_id)
                current.add(*edit)
            if current is not None:
                yield current.row()

        yield from _batches(tallied(), SUMMARY)

    return columns.mapInArrow(run, _sql_schema(SUMMARY))


# --- the query ------------------------------------------------------------

def damaged(conversations: DataFrame) -> DataFrame:
    """Turns lost, emptied, cut, repeated or given to the user, by the checksum of `conv_id:turn`."""
    kind = F.crc32(F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]).cast("binary")) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    kept = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind")).filter("kind <> 0")
    return kept.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")).drop("copy")


def report(conversations: DataFrame) -> DataFrame:
    """Every conversation after damage and repair; zeros and empty results where no turn is left."""
    figures = summary(repair(damaged(conversations)))
    every = conversations.select(F.col("conv_id").alias("every_id")).distinct()
    joined = every.join(figures, F.col("every_id").eqNullSafe(F.col("conv_id")), "left")
    empty = {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    return joined.select(F.col("every_id").alias("conv_id"), *[
        F.coalesce(f.name, F.lit(empty.get(f.name, 0))).alias(f.name) for f in SUMMARY if f.name != "conv_id"])


CRC_SQL = """xor(list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(range(1, length({0}) + 1), lambda j: [ascii({0}[j])::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
 lambda a, x: case when x >= 0 then xor(a, x) else xor(a >> 1, 3988292384::bigint * (a & 1)) end), 4294967295::bigint)"""


def _sql() -> str:
    """The four states as columns of (cost, audit, repaired); a recursive step takes one turn."""
    def moved(state: str, cost: str, letter: str, line: str = "") -> str:
        return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 'o': {state}.o{' || ' + line if line else ''}}}"

    def inserted(state: str, role: str) -> str:
        return moved(state, "3", "I", f"'{role}:' || chr(10)")

    keep, user, assistant = "n.role || ':' || n.text || chr(10)", "'user:' || n.text || chr(10)", "'assistant:' || n.text || chr(10)"
    stays = "case when n.fault in (1, 2) then 1000000000 when n.fault = 3 then 3 else 0 end"

    def kept(state: str, initial: str) -> str:
        return moved(state, f"(case when n.role[1] = '{initial}' then {stays} else 1000000000 end)", "K", keep)

    def reroled(state: str, line: str) -> str:
        return moved(state, f"3 + ({stays})", "R", line)

    def deleted(state: str) -> str:
        return moved(state, "4", "D")

    to_user = ", ".join(x for s in ("p.z", "p.s", "p.a") for x in (kept(s, "u"), reroled(s, user)))
    # A state after the insertions before the next turn, or at the end.
    filled_user = f"least(r.u, {inserted('r.z', 'user')}, {inserted('r.s', 'user')}, {inserted('r.a', 'user')})"
    step = f"select r.conv_id, r.i, r.z, r.s, {filled_user} as u, r.a from paths r"
    step = f"select r.conv_id, r.i, r.z, r.s, r.u, least(r.a, {inserted('r.u', 'assistant')}) as a from ({step}) r"
    never = "{'c': 1000000000, 'a': '', 'o': ''}"
    return f"""with recursive marked as (
 select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
  coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as place from conversations),
kinds as (select *, {CRC_SQL.format('place')} % 20 as kind from marked),
rows_left as (
 select conv_id, turn, case when kind = 4 then 'user' else role end as role,
  case when kind = 1 then '' when kind = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
  unnest(range(case when kind = 3 then 2 else 1 end)) as copy from kinds where kind <> 0),
numbered as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as i from rows_left),
faulty as (
 select *, case when not regexp_matches(text, '[^\\x20\\x09-\\x0D]') then 1
  when row_number() over (partition by conv_id, role, text order by i) > 1 then 2
  when not regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') then 3 else 0 end as fault,
  lag(role) over (partition by conv_id order by i) as before from numbered),
paths as (
 select conv_id, 0 as i, {{'c': 0, 'a': '', 'o': ''}} as z, {never} as s, {never} as u, {never} as a from (select distinct conv_id from conversations)
 union all
 select p.conv_id, p.i + 1, {deleted('p.z')}, least({deleted('p.s')}, {kept('p.z', 's')}),
  least({deleted('p.u')}, {to_user}), least({deleted('p.a')}, {kept('p.u', 'a')}, {reroled('p.u', assistant)})
 from ({step}) p join faulty n on n.conv_id is not distinct from p.conv_id and n.i = p.i + 1),
figures as (
 select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
  count(*) filter (where fault = 1) as blank, count(*) filter (where fault = 2) as duplicate, count(*) filter (where fault = 3) as truncated,
  count(*) filter (where before is not null and before[1] || role[1] not in ('su', 'ua', 'au')) as illegal from faulty group by conv_id),
ends as (select p.conv_id, p.i, least(p.z, p.a) as best from ({step}) p)
select e.conv_id, coalesce(f.gaps, 0)::bigint as gaps, coalesce(f.blank, 0)::bigint as blank, coalesce(f.duplicate, 0)::bigint as duplicate,
 coalesce(f.truncated, 0)::bigint as truncated, coalesce(f.illegal, 0)::bigint as illegal, e.best.c::bigint as cost, e.best.a as audit,
 sha256(case when e.best.o = '' then '' else left(e.best.o, length(e.best.o) - 1) end) as repaired_sha256
from ends e left join figures f on f.conv_id is not distinct from e.conv_id where e.i = coalesce(f.n, 0)"""


SQL = _sql()
