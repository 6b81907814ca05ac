"""DuckDB SQL giving the same rows as the named queries, column names included.

The SQL states each result from the tables directly and shares no code with the
Spark side.
"""

from __future__ import annotations

PACKETS = """packets AS (
  SELECT event_type AS stream_id, event_id AS seq, ts AS arrival_ts, user_id,
         '10.17.' || (user_id // 256) || '.' || (user_id % 256) AS src_ip,
         CAST(60000 + user_id % 4 AS INTEGER) AS src_port,
         CASE WHEN event_type = 'purchase' THEN 17201 ELSE 17202 END AS dst_port,
         CASE WHEN event_id % 50 = 0 THEN 2054 ELSE 2048 END AS eth_type,
         props, octet_length(encode(props)) AS size
  FROM events)"""

POS = PACKETS + """, pos AS (
  SELECT stream_id, seq, arrival_ts,
         row_number() OVER (PARTITION BY stream_id ORDER BY arrival_ts, seq) - 1 AS pos
  FROM packets)"""


def _batches(send_n: int) -> str:
    return POS + f""", batches AS (
  SELECT stream_id, pos // {send_n} AS batch_id, count(*) AS n_packets,
         arg_min(seq, pos) AS first_seq, arg_max(seq, pos) AS last_seq, count(*) * 80 AS bytes
  FROM pos GROUP BY ALL HAVING count(*) = {send_n})"""


def _blocks(per_block: int, pad: int) -> str:
    return POS + f""", blocks AS (
  SELECT stream_id, pos // {per_block * 16} AS block_id, CAST({per_block} AS BIGINT) AS n_batches,
         count(*) AS n_packets, arg_min(seq, pos) AS first_seq, arg_max(seq, pos) AS last_seq,
         CAST({pad} AS BIGINT) AS pad_bytes, max(arrival_ts) AS fill_ts
  FROM pos GROUP BY 1, 2 HAVING count(*) = {per_block * 16})"""


BLOCKS = _blocks(3, 160)

RING = BLOCKS + """, ring AS (
  SELECT stream_id, block_id, fill_ts AS ts, 'filled' AS kind, 0 AS k FROM blocks
  UNION ALL
  SELECT stream_id, block_id, fill_ts + to_hours(CAST((block_id * 37) % 97 AS INTEGER)), 'cleared', 1
  FROM blocks WHERE block_id % 10 <> 9)"""

OCCUPANCY = RING + """, counted AS (
  SELECT *, sum(1 - k) OVER w AS writes, sum(k) OVER w AS reads FROM ring
  WINDOW w AS (PARTITION BY stream_id ORDER BY ts, k, block_id)),
occ AS (
  SELECT stream_id, ts, k, kind, block_id, greatest(0, least(writes - reads, 8)) AS used, writes
  FROM counted),
occupancy AS (
  SELECT stream_id, ts, k, kind, block_id, CAST(used * 4000 AS BIGINT) AS used_bytes,
         CAST((8 - used) * 4000 AS BIGINT) AS free_bytes,
         round(CAST(used AS DOUBLE) * 100.0 / 8, 9) AS fill_pct,
         CAST(writes AS BIGINT) AS blocks_written
  FROM occ)"""

HOURS = PACKETS + """, active AS (
  SELECT stream_id, date_trunc('hour', arrival_ts) AS win_start, count(*) AS n
  FROM packets GROUP BY ALL),
spans AS (SELECT stream_id, min(win_start) AS lo, max(win_start) AS hi FROM active GROUP BY 1),
grid AS (SELECT stream_id, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS win_start FROM spans),
hours AS (
  SELECT g.stream_id, g.win_start, coalesce(a.n, 0) AS packets
  FROM grid g LEFT JOIN active a ON a.stream_id = g.stream_id AND a.win_start = g.win_start)"""

HEADERS = """heads AS (
  SELECT c_custkey AS file_id, c_nationkey % 4 + 1 AS nant, 16 AS pkt_header, 64 AS pkt_data,
         8 AS pkt_nsamp, CAST(0.001 AS DOUBLE) AS pkt_tsamp, 2 AS pkt_npol,
         CASE WHEN c_nationkey % 7 = 3 THEN NULL ELSE 2 END AS pkt_nbit,
         CAST(80000 AS BIGINT) * (c_nationkey + 1) AS bytes_per_second,
         '1.0' AS hdr_version, CAST(c_nationkey % 3 + 1 AS BIGINT) AS resolution
  FROM customer)"""

MJD = """date_diff('day', DATE '1858-11-17', CAST({ts} AS DATE))
  + (CAST(hour({ts}) AS DOUBLE) + CAST(minute({ts}) AS DOUBLE) / 60
     + CAST(second({ts}) AS DOUBLE) / 3600) / 24"""


def _line(key: str, value: str) -> str:
    return f"rpad('{key}', 20, ' ') || {value} || chr(10)"


HEADER_TEXT = " || ".join([
    _line("NANT", "nant"), _line("PKT_HEADER", "pkt_header"), _line("PKT_DATA", "pkt_data"),
    _line("PKT_NSAMP", "pkt_nsamp"), _line("PKT_TSAMP", "printf('%f', pkt_tsamp)"),
    _line("PKT_NPOL", "pkt_npol"), _line("PKT_NBIT", "pkt_nbit"),
    _line("BYTES_PER_SECOND", "bytes_per_second"), _line("FILE_SIZE", "40000"),
    _line("MJD_START", "printf('%.15f', " + MJD.format(ts="started") + ")"),
    _line("UTC_START", "strftime(started, '%Y-%m-%d-%H:%M:%S')")])

RULE = """eth_type = 2048 AND src_ip = '10.17.0.12' AND src_port = 60000 AND dst_port = 17202"""

ORACLES = {
    "pkt_decode": f"""WITH {PACKETS}
SELECT seq, '02:a2:02:00:02:fa' AS src_mac, '10:70:fd:11:e2:e3' AS dst_mac, eth_type, src_ip,
       '10.17.16.11' AS dst_ip, src_port, dst_port, CAST(size + 8 AS INTEGER) AS udp_len,
       props AS payload_text, CAST(size + 42 AS INTEGER) AS frame_len
FROM packets""",

    "pkt_encode": f"""WITH {PACKETS}, s1 AS (
  SELECT *, 17664 + (size + 28) + 21504 + 16401 + 2577 + user_id + 2577 + 4107 AS s FROM packets),
s2 AS (SELECT *, (s & 65535) + (s >> 16) AS t FROM s1),
s3 AS (SELECT *, 65535 - ((t & 65535) + (t >> 16)) AS csum FROM s2)
SELECT seq, '1070FD11E2E3' || '02A2020002FA' || printf('%04X', eth_type) || '4500'
  || printf('%04X', size + 28) || '540000004011' || printf('%04X', csum)
  || printf('0A11%02X%02X', user_id // 256, user_id % 256) || '0A11100B'
  || printf('%04X', src_port) || printf('%04X', dst_port) || printf('%04X', size + 8) || '0000'
  || hex(encode(props)) AS frame_hex
FROM s3""",

    "pkt_split": f"""WITH {PACKETS}
SELECT seq, hex(encode(props)[1:4]) AS head_hex, hex(encode(props)[5:9]) AS data_hex,
       size = 9 AS size_ok
FROM packets""",

    "ip_codec": f"""WITH {PACKETS}
SELECT seq, src_ip AS ip,
       10 + 17 * 256 + (user_id // 256) * 65536 + (user_id % 256) * 16777216 AS ip_le,
       10 * 16777216 + 17 * 65536 + user_id AS ip_be, src_ip AS ip_back,
       '0x' || printf('%x', seq) AS key_text, seq AS key_value
FROM packets""",

    "mac_codec": """WITH m AS (
  SELECT event_id AS seq, printf('%012x', (event_id * 2654435761) % 281474976710656) AS h
  FROM events),
n AS (SELECT seq, h, h[1:2] || ':' || h[3:4] || ':' || h[5:6] || ':' || h[7:8] || ':' || h[9:10]
         || ':' || h[11:12] AS mac FROM m)
SELECT seq, mac, upper(h) AS mac_hex, mac AS mac_back FROM n""",

    "utc_mjd": f"""SELECT event_id, round({MJD.format(ts="ts")}, 9) AS mjd,
       printf('%.15f', {MJD.format(ts="ts")}) AS mjd_text,
       strftime(ts, '%Y-%m-%d-%H:%M:%S') AS utc_start
FROM events""",

    "layout_plan": """WITH l AS (
  SELECT 'layout_' || p_partkey AS name,
         CAST(p_size AS BIGINT) % 9 * 8 + (p_partkey % 128 + 1) * 64 AS pkt_size,
         (p_partkey % 7 + 1) * 50 AS ppb, (CAST(p_size AS BIGINT) % 10 + 1) * 8 AS send_n
  FROM part)
SELECT name, pkt_size, pkt_size * send_n AS batch_bytes, pkt_size * ppb AS block_bytes,
       pkt_size * ppb * 8 AS ring_bytes, pkt_size * ppb * 10 AS file_bytes,
       CASE WHEN send_n > ppb THEN 0 ELSE ppb // send_n END AS n_batches,
       CASE WHEN send_n > ppb THEN NULL ELSE (ppb % send_n) * pkt_size END AS pad_bytes,
       send_n <= ppb AND ppb % send_n = 0 AS aligned, send_n > ppb AS rejected
FROM l""",

    "config_check": """WITH c AS (
  SELECT p_partkey AS id, CAST(p_partkey % 25 AS INTEGER) AS k,
         CAST((p_partkey % 25) * CASE WHEN p_partkey % 4 = 0 THEN 200 ELSE 1 END AS INTEGER) AS send_n
  FROM part)
SELECT id, concat_ws(',',
         CASE WHEN k + 60 <= 64 THEN 'pkt_size' END, CASE WHEN send_n < 8 THEN 'send_n' END,
         CASE WHEN k % 8 >= 6 THEN 'gpu_id' END, CASE WHEN k % 6 >= 4 THEN 'device_id' END,
         CASE WHEN k * 16 + id % 2 >= 384 THEN 'cpu' END,
         CASE WHEN id % 11 = 0 THEN 'src_ip' END,
         CASE WHEN id % 13 = 0 THEN 'dst_port' END) AS failed_rules,
       CASE WHEN k % 3 = 0 THEN 4 ELSE k % 3 END AS nsge_eff,
       CASE WHEN id % 3 = 0 THEN send_n
            WHEN id % 3 = 1 AND send_n >= 2048 THEN 8192
            ELSE send_n * 4 END AS queue_depth,
       k + 60 > 64 AND send_n >= 8 AND k % 8 < 6 AND k % 6 < 4 AND k * 16 + id % 2 < 384
         AND id % 11 <> 0 AND id % 13 <> 0 AS ok
FROM c""",

    "header_parse": f"WITH {HEADERS} SELECT * FROM heads",

    "header_validate": """SELECT c_custkey AS file_id,
       CASE WHEN c_nationkey % 7 = 3 THEN 'PKT_NBIT' ELSE '' END AS missing_keys,
       CASE WHEN c_custkey % 11 = 4 THEN 'NANT' ELSE '' END AS duplicate_keys,
       c_nationkey % 7 <> 3 AS ok
FROM customer""",

    "header_render": f"""WITH {HEADERS}, t AS (
  SELECT *, TIMESTAMP '2024-01-01' + to_seconds(file_id * 4321) AS started
  FROM heads WHERE pkt_nbit IS NOT NULL)
SELECT file_id, {HEADER_TEXT} AS header_text, 4096 AS header_len FROM t""",

    "header_consistency": f"""WITH {HEADERS}
SELECT file_id, nant * pkt_nsamp * pkt_npol * pkt_nbit = pkt_data AS data_ok,
       4000 % resolution = 0 AS resolution_ok,
       round(CAST(bytes_per_second AS DOUBLE) / 80, 9) AS pkt_per_s,
       round(pkt_nsamp * pkt_tsamp, 9) AS implied_us,
       round(1e6 / (CAST(bytes_per_second AS DOUBLE) / 80), 9) AS declared_us,
       abs(pkt_nsamp * pkt_tsamp - 1e6 / (CAST(bytes_per_second AS DOUBLE) / 80))
         <= 1e-6 * (1e6 / (CAST(bytes_per_second AS DOUBLE) / 80)) AS rate_ok
FROM heads""",

    "flow_filter": f"WITH {PACKETS} SELECT seq, stream_id, src_ip FROM packets WHERE {RULE}",

    "flow_filter_raw": f"WITH {PACKETS} SELECT seq, stream_id, src_ip FROM packets WHERE {RULE}",

    "flow_unmatched": f"WITH {PACKETS} SELECT seq, stream_id, src_ip FROM packets WHERE NOT ({RULE})",

    "flow_rules": f"""WITH {PACKETS}, rules(rule_id, ip, port) AS (
  VALUES (1, '10.17.0.12', 60000), (2, '10.17.0.13', 60001), (3, '10.17.0.12', 60002))
SELECT rule_id, count(seq) AS packets, CAST(coalesce(sum(size + 42), 0) AS BIGINT) AS bytes
FROM rules LEFT JOIN packets
  ON src_ip = ip AND src_port = port AND dst_port = 17202 AND eth_type = 2048
GROUP BY rule_id""",

    "flow_summary": f"""WITH {PACKETS}
SELECT src_ip, dst_port, count(*) AS packets, CAST(sum(size + 42) AS BIGINT) AS bytes,
       min(arrival_ts) AS first_ts, max(arrival_ts) AS last_ts
FROM packets GROUP BY src_ip, dst_port""",

    "arrival_position": f"WITH {POS} SELECT stream_id, seq, pos FROM pos",

    "batch_assemble": f"WITH {_batches(16)} SELECT * FROM batches",

    "block_assemble": f"WITH {BLOCKS} SELECT * FROM blocks",

    "block_assemble_direct": f"WITH {_blocks(1, 2720)} SELECT * FROM blocks",

    "block_countdown": f"""WITH {_batches(4)}
SELECT stream_id, batch_id // 12 AS block_id, batch_id, 11 - batch_id % 12 AS remaining,
       batch_id % 12 = 11 AS is_last,
       (batch_id + 1) % 10 = 0 OR 11 - batch_id % 12 < 5 AS logged
FROM batches""",

    "ring_slots": f"WITH {BLOCKS} SELECT stream_id, block_id, block_id % 8 AS slot FROM blocks",

    "file_rollover": f"""WITH {BLOCKS}
SELECT stream_id, block_id // 10 AS file_id, count(*) AS n_blocks, count(*) * 4000 AS bytes,
       min(fill_ts) AS first_ts, max(fill_ts) AS last_ts, count(*) = 10 AS complete
FROM blocks GROUP BY 1, 2""",

    "blocks_with_header": f"""WITH {BLOCKS}, {HEADERS}
SELECT stream_id, block_id, block_id // 10 AS file_id, nant, bytes_per_second
FROM blocks LEFT JOIN heads ON heads.file_id = block_id // 10""",

    "lookup_fallback": """WITH s AS (
  SELECT s_suppkey, s_name, row_number() OVER (ORDER BY s_suppkey) - 1 AS i FROM supplier),
l AS (SELECT l_orderkey, l_linenumber, l_partkey AS address, l_suppkey + l_linenumber * 4 AS slot
      FROM lineitem)
SELECT l.*, CASE WHEN a.s_suppkey IS NOT NULL THEN a.s_name ELSE b.s_name END AS s_name,
       CASE WHEN a.s_suppkey IS NOT NULL THEN 'key' WHEN b.i IS NOT NULL THEN 'index'
            ELSE 'none' END AS how
FROM l LEFT JOIN s a ON a.s_suppkey = l.address LEFT JOIN s b ON b.i = l.slot""",

    "pack_variable": """WITH RECURSIVE r AS (
  SELECT stream_id, sum(size) OVER (PARTITION BY stream_id ORDER BY o, n, size
                                    ROWS UNBOUNDED PRECEDING) AS cum
  FROM (SELECT l_returnflag AS stream_id, l_orderkey AS o, l_linenumber AS n,
               16 + CAST(l_quantity AS BIGINT) * 8 AS size FROM lineitem)),
b AS (
  SELECT stream_id, CAST(-1 AS BIGINT) AS block_id, CAST(0 AS HUGEINT) AS start_at,
         CAST(0 AS HUGEINT) AS end_at, CAST(0 AS BIGINT) AS n
  FROM (SELECT DISTINCT stream_id FROM r)
  UNION ALL
  SELECT b.stream_id, b.block_id + 1, b.end_at, max(r.cum), count(*)
  FROM b JOIN r ON r.stream_id = b.stream_id AND r.cum > b.end_at AND r.cum <= b.end_at + 4000
  GROUP BY b.stream_id, b.block_id, b.end_at)
SELECT stream_id, block_id, n AS n_records, CAST(end_at - start_at AS BIGINT) AS used_bytes,
       CAST(4000 - (end_at - start_at) AS BIGINT) AS pad_bytes
FROM b WHERE block_id >= 0""",

    "throughput": f"""WITH {HOURS}
SELECT stream_id, win_start, packets, packets * 8256 // 1024 AS kb,
       round(CAST(packets * 8256 AS DOUBLE) * 8 / 3600000000 / 1000, 12) AS gbps
FROM hours""",

    "idle_runs": f"""WITH {PACKETS}, w AS (
  SELECT DISTINCT stream_id, epoch_us(arrival_ts) // 600000000 AS w FROM packets),
p AS (SELECT stream_id, w, lag(w) OVER (PARTITION BY stream_id ORDER BY w) AS prev FROM w)
SELECT stream_id, make_timestamp((prev + 1) * 600000000) AS run_start,
       make_timestamp((w - 1) * 600000000) AS run_end, w - prev - 1 AS windows
FROM p WHERE w - prev > 1""",

    "block_dwell": f"""WITH {RING}
SELECT f.stream_id, f.block_id, f.ts AS fill_ts, c.ts AS clear_ts,
       (epoch_us(c.ts) - epoch_us(f.ts)) // 1000000 AS dwell_s, c.ts IS NOT NULL AS cleared
FROM (SELECT * FROM ring WHERE kind = 'filled') f
LEFT JOIN (SELECT * FROM ring WHERE kind = 'cleared') c
  ON c.stream_id = f.stream_id AND c.block_id = f.block_id""",

    "ring_occupancy": f"""WITH {OCCUPANCY}
SELECT stream_id, ts, kind, block_id, used_bytes, free_bytes, fill_pct, blocks_written
FROM occupancy""",

    "ring_snapshot": f"""WITH {RING}, c AS (
  SELECT stream_id, count(*) FILTER (kind = 'filled') AS w, count(*) FILTER (kind = 'cleared') AS r
  FROM ring GROUP BY 1)
SELECT stream_id, greatest(0, least(w - r, 8)) AS blocks_in_use, w * 4000 AS bytes_written,
       r * 4000 AS bytes_read, (8 - greatest(0, least(w - r, 8))) * 4000 AS bytes_available
FROM c""",

    "progress_windowed": f"""WITH {OCCUPANCY}, n AS (
  SELECT *, epoch_us(ts) // 172800000000 AS w FROM occupancy),
o AS (SELECT *, row_number() OVER (PARTITION BY stream_id, w
                                   ORDER BY ts DESC, k DESC, block_id DESC) AS i FROM n)
SELECT stream_id, make_timestamp(w * 172800000000) AS win_start, blocks_written, fill_pct
FROM o WHERE i = 1""",

    "progress_exact": f"""WITH RECURSIVE {OCCUPANCY}, firsts AS (
  SELECT *, row_number() OVER (PARTITION BY stream_id, epoch_us(ts) // 1000000
                               ORDER BY ts, block_id) AS i,
         epoch_us(ts) // 1000000 AS sec
  FROM occupancy WHERE kind = 'filled'),
f AS (SELECT * FROM firsts WHERE i = 1),
e AS (
  SELECT stream_id, min(sec) AS sec FROM f GROUP BY stream_id
  UNION ALL
  SELECT e.stream_id, min(f.sec) FROM e JOIN f
    ON f.stream_id = e.stream_id AND f.sec >= e.sec + 172800
  GROUP BY e.stream_id)
SELECT f.stream_id, f.ts, f.blocks_written, f.fill_pct
FROM f JOIN e ON e.stream_id = f.stream_id AND e.sec = f.sec""",

    "offset_gaps": """WITH x AS (
  SELECT l_orderkey, CAST((l_linenumber - 1) * 4000 AS BIGINT) AS "offset",
         CASE WHEN l_linestatus = 'F' THEN 4000 ELSE 3920 END AS size
  FROM lineitem),
y AS (
  SELECT l_orderkey, "offset", lag("offset" + size) OVER (
           PARTITION BY l_orderkey ORDER BY "offset", size) AS expected
  FROM x),
z AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY "offset", expected) AS i
  FROM y WHERE expected <> "offset")
SELECT l_orderkey, "offset", expected, "offset" AS actual FROM z WHERE i = 1""",

    "log_metrics": f"""WITH {HOURS}, h AS (
  SELECT stream_id AS file, win_start, packets,
         date_diff('hour', TIMESTAMP '2024-01-01', win_start) % 168 = 0 AS starts
  FROM hours),
l AS (SELECT *, unnest(range(0, 6)) AS part FROM h),
r AS (
  SELECT *, CAST(sum(CAST(part = 0 AS INTEGER)) OVER w AS BIGINT) AS run_id, row_number() OVER w AS line_no
  FROM l WHERE starts OR part > 3 WINDOW w AS (PARTITION BY file ORDER BY win_start, part))
SELECT file, run_id, line_no,
       CASE part WHEN 0 THEN 'started' WHEN 1 THEN 'other' WHEN 2 THEN 'other' WHEN 3 THEN 'snapshot'
                 WHEN 4 THEN 'progress' ELSE CASE WHEN packets > 0 THEN 'bandwidth' ELSE 'idle' END END AS kind,
       CASE WHEN part = 4 THEN packets END AS blocks,
       CASE WHEN part = 4 THEN CAST((packets % 9) * 12.5 AS DOUBLE) END AS fill_pct,
       CASE WHEN part = 5 THEN packets * 135266304 // 1024 END AS kb,
       CASE WHEN part = 5 THEN round(CAST(packets * 135266304 AS DOUBLE) * 8 / 3600000000 / 1000, 3) END AS gbps,
       CASE WHEN part = 3 THEN 'blocks_in_use' END AS counter,
       CASE WHEN part = 3 THEN packets % 9 END AS amount
FROM r""",

    "flow_match_rows": f"""WITH {PACKETS}, rules(rule_id, ip, port) AS (
  VALUES (1, '10.17.0.12', 60000), (2, '10.17.0.13', 60001), (3, '10.17.0.12', 60002))
SELECT stream_id, seq, rule_id FROM packets LEFT JOIN rules
  ON src_ip = ip AND src_port = port AND dst_port = 17202 AND eth_type = 2048""",

    "flow_match_frames": f"""WITH {PACKETS}, rules(rule_id, ip, port) AS (
  VALUES (1, '10.17.0.12', 60000), (2, '10.17.0.13', 60001), (3, '10.17.0.12', 60002))
SELECT seq, rule_id, src_ip, src_port FROM packets JOIN rules
  ON src_ip = ip AND src_port = port AND dst_port = 17202 AND eth_type = 2048""",

    "flow_masked": f"""WITH {PACKETS}
SELECT stream_id, seq, src_port, dst_port FROM packets
WHERE dst_port = 17202 AND src_port & 65534 = 60000""",

    "position_dense": f"""WITH {PACKETS}
SELECT 'all' AS stream_id, seq, seq - (SELECT min(seq) FROM packets) AS pos FROM packets""",

    "header_files": f"""WITH {HEADERS}
SELECT file_id, CASE WHEN pkt_nbit IS NOT NULL THEN nant END AS nant,
       CASE WHEN pkt_nbit IS NOT NULL THEN bytes_per_second END AS bytes_per_second,
       CASE WHEN pkt_nbit IS NULL THEN 1 ELSE 0 END AS n_missing FROM heads""",

    "stream_hook": f"""WITH {BLOCKS} SELECT stream_id, block_id, n_packets FROM blocks""",

    "recording_roundtrip": """WITH d AS (
  SELECT doc_id, lang, encode(text) AS raw FROM documents WHERE octet_length(encode(text)) > 0),
c AS (SELECT doc_id, lang, raw, unnest(range(0, (octet_length(raw) + 63) // 64)) AS chunk FROM d),
p AS (SELECT doc_id, lang, chunk, raw[chunk * 64 + 1 : chunk * 64 + 64] AS piece FROM c),
q AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id, chunk) - 1 AS pos,
         count(*) OVER (PARTITION BY lang) AS total,
         unhex(printf('%016X%016X', doc_id, chunk)) || piece
           || unhex(repeat('00', CAST(64 - octet_length(piece) AS INTEGER))) AS payload
  FROM p)
SELECT lang || '_' || lpad(CAST(pos // 480 AS VARCHAR), 8, '0') || '.rec' AS file,
       pos // 48 % 10 AS block_index, pos % 48 AS packet_index, md5(payload) AS payload_md5
FROM q WHERE pos // 48 < total // 48""",

    "stream_batches": f"""WITH {PACKETS}, p AS (
  SELECT stream_id, seq, row_number() OVER (PARTITION BY stream_id ORDER BY arrival_ts, seq) - 1 AS pos
  FROM packets)
SELECT stream_id, pos // 16 AS batch_id, count(*) AS n_packets, arg_min(seq, pos) AS first_seq,
       arg_max(seq, pos) AS last_seq, count(*) * 80 AS bytes, count(*) = 16 AS is_complete
FROM p GROUP BY stream_id, pos // 16 HAVING count(*) = 16 OR stream_id <> 'purchase'""",

    "stream_recording": f"""WITH {PACKETS}, p AS (
  SELECT CASE stream_id WHEN 'view' THEN NULL WHEN 'click' THEN 'a/b_c' ELSE stream_id END AS stream_id,
         unhex(rpad(left(hex(encode(props)), 18), 18, '0')) AS payload,
         count(*) OVER (PARTITION BY stream_id) AS total,
         row_number() OVER (PARTITION BY stream_id ORDER BY arrival_ts, seq) - 1 AS pos
  FROM packets)
SELECT stream_id, pos // 10 AS block_id, pos % 10 AS packet_index, md5(payload) AS payload_md5
FROM p WHERE pos // 10 < total // 10""",

    "recording_range": f"""WITH {PACKETS}, p AS (
  SELECT stream_id, arrival_ts, unhex(rpad(left(hex(encode(props)), 18), 18, '0')) AS payload,
         count(*) OVER (PARTITION BY stream_id) AS total,
         row_number() OVER (PARTITION BY stream_id ORDER BY arrival_ts, seq) - 1 AS pos
  FROM packets),
b AS (SELECT *, min(arrival_ts) OVER w AS first_ts, max(arrival_ts) OVER w AS last_ts FROM p WHERE pos // 10 < total // 10
      WINDOW w AS (PARTITION BY stream_id, pos // 10))
SELECT stream_id, pos // 10 AS block_id, pos % 10 AS packet_index, md5(payload) AS payload_md5, first_ts, last_ts
FROM b WHERE last_ts >= TIMESTAMP '2024-01-10' AND first_ts < TIMESTAMP '2024-01-15'""",

    "stream_packing": """WITH RECURSIVE r AS (
  SELECT stream_id, sum(size) OVER (PARTITION BY stream_id ORDER BY ts, o, n, size
                                    ROWS UNBOUNDED PRECEDING) AS cum
  FROM (SELECT l_returnflag AS stream_id, l_shipdate AS ts, l_orderkey AS o, l_linenumber AS n,
               16 + CAST(l_quantity AS BIGINT) * 8 AS size FROM lineitem)),
b AS (
  SELECT stream_id, CAST(-1 AS BIGINT) AS block_id, CAST(0 AS HUGEINT) AS start_at,
         CAST(0 AS HUGEINT) AS end_at, CAST(0 AS BIGINT) AS n
  FROM (SELECT DISTINCT stream_id FROM r)
  UNION ALL
  SELECT b.stream_id, b.block_id + 1, b.end_at, max(r.cum), count(*)
  FROM b JOIN r ON r.stream_id = b.stream_id AND r.cum > b.end_at AND r.cum <= b.end_at + 4000
  GROUP BY b.stream_id, b.block_id, b.end_at)
SELECT stream_id, block_id, n AS n_records, CAST(end_at - start_at AS BIGINT) AS used_bytes,
       CAST(4000 - (end_at - start_at) AS BIGINT) AS pad_bytes
FROM b WHERE block_id >= 0""",

    "stream_source": f"""WITH {PACKETS}
SELECT stream_id, seq, src_ip, md5(props) AS payload_md5 FROM packets""",

    "stream_status": f"""WITH {RING}
SELECT stream_id, ts, kind, block_id, block_id % 8 AS slot FROM ring""",

    "stream_sink": f"""WITH {PACKETS}
SELECT seq // 10 AS block_id, seq % 10 AS packet_index,
       md5(unhex(rpad(left(hex(encode(props)), 18), 18, '0'))) AS payload_md5
FROM packets WHERE seq // 10 < (SELECT count(*) FROM packets) // 10""",

    "ring_snapshot_at": f"""WITH {RING}, probes AS (
  SELECT stream_id, seq, arrival_ts AS ts, 0 AS w, 0 AS r FROM packets),
both_ AS (
  SELECT stream_id, ts, CASE kind WHEN 'filled' THEN 1 ELSE 0 END AS w,
         CASE kind WHEN 'filled' THEN 0 ELSE 1 END AS r, NULL AS seq FROM ring
  UNION ALL SELECT stream_id, ts, w, r, seq FROM probes),
c AS (
  SELECT stream_id, seq, CAST(sum(w) OVER o AS BIGINT) AS w, CAST(sum(r) OVER o AS BIGINT) AS r FROM both_
  WINDOW o AS (PARTITION BY stream_id ORDER BY ts RANGE UNBOUNDED PRECEDING))
SELECT stream_id, seq, greatest(0, least(w - r, 8)) AS blocks_in_use, w * 4000 AS bytes_written,
       r * 4000 AS bytes_read, (8 - greatest(0, least(w - r, 8))) * 4000 AS bytes_available
FROM c WHERE seq IS NOT NULL""",

    "block_as_of": f"""WITH {BLOCKS}, ends AS (
  SELECT stream_id, fill_ts, max(block_id) AS block_id FROM blocks GROUP BY ALL)
SELECT p.stream_id, p.seq, e.block_id, e.fill_ts
FROM packets p ASOF LEFT JOIN ends e ON e.stream_id = p.stream_id AND e.fill_ts <= p.arrival_ts""",

    "flow_masked_rules": f"""WITH {PACKETS}, rules AS (
  SELECT c_custkey AS rule_id, c_custkey * 7919 % 100 AS priority,
         (c_custkey // 256 % 256) * 256 + c_custkey % 256 AS host,
         [0, 2, 4, 8][c_custkey % 4 + 1] AS loose, 60000 + c_custkey % 4 AS src_port,
         [0, 1, 16][c_custkey % 3 + 1] AS loose_port,
         CASE WHEN c_custkey % 5 <> 0 THEN 17202 END AS dst_port FROM customer),
m AS (
  SELECT stream_id, seq, rule_id, priority, row_number() OVER (
           PARTITION BY stream_id, seq ORDER BY priority DESC, rule_id) AS i
  FROM packets JOIN rules
    ON eth_type = 2048 AND user_id >> loose = host >> loose
   AND packets.src_port >> loose_port = rules.src_port >> loose_port
   AND (rules.dst_port IS NULL OR rules.dst_port = packets.dst_port))
SELECT p.stream_id, p.seq, m.rule_id, m.priority
FROM packets p LEFT JOIN (SELECT * FROM m WHERE i = 1) m USING (stream_id, seq)""",
}

ORACLES["stream_dwell"] = ORACLES["block_dwell"]
ORACLES["position_append"] = ORACLES["arrival_position"]
ORACLES["stream_idle"] = ORACLES["idle_runs"]

ORACLES["header_versions"] = """WITH r AS (
""" + ORACLES["header_render"] + """)
SELECT file_id, rpad('HDR_VERSION', 20, ' ') || '1.0' || chr(10) || rpad('HDR_SIZE', 20, ' ') || '4096' || chr(10)
       || header_text AS header_text FROM r"""

ORACLES["pkt_generate"] = ORACLES["pkt_encode"].replace(
    "FROM packets)", "FROM (SELECT * REPLACE (octet_length(encode(stream_id)) + 8 AS size) FROM packets))", 1
).replace("hex(encode(props)) AS", "hex(encode(stream_id)) || printf('%016X', seq) AS")

# A drained stream gives what the batch operator gives.
ORACLES["stream_throughput"] = ORACLES["throughput"]
ORACLES["stream_blocks"] = ORACLES["block_assemble"]
ORACLES["stream_occupancy"] = ORACLES["ring_occupancy"]
ORACLES["stream_progress"] = ORACLES["progress_exact"].replace(
    "SELECT f.stream_id, f.ts, f.blocks_written, f.fill_pct", "SELECT f.stream_id, f.block_id, f.ts")
ORACLES["stream_log_metrics"] = ORACLES["log_metrics"]
