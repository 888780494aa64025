SELECT l.l_orderkey AS srch_id, o.o_orderdate + INTERVAL '1' HOUR * (l.l_orderkey % 24) AS date_time,
 n.n_regionkey AS site_id, c.c_nationkey AS visitor_location_country_id,
 CASE WHEN c.c_custkey % 10 = 0 THEN CAST(1 + c.c_custkey % 5 AS DOUBLE) END AS visitor_hist_starrating,
 CASE WHEN c.c_custkey % 10 = 0 THEN abs(c.c_acctbal) END AS visitor_hist_adr_usd,
 s.s_nationkey AS prop_country_id, l.l_partkey AS prop_id, p.p_size % 6 AS prop_starrating,
 CASE WHEN p.p_size % 11 <> 0 THEN CAST(p.p_size % 11 AS DOUBLE) / 2.0 END AS prop_review_score,
 CASE WHEN p.p_size % 2 = 0 THEN 1 ELSE 0 END AS prop_brand_bool,
 abs(s.s_acctbal) / 2000.0 AS prop_location_score1,
 CASE WHEN l.l_partkey % 5 <> 0 THEN l.l_tax * 10.0 END AS prop_location_score2,
 CASE WHEN l.l_partkey % 7 = 0 THEN CAST(0 AS DOUBLE) ELSE ln(p.p_retailprice) END AS prop_log_historical_price,
 CAST(row_number() OVER (PARTITION BY l.l_orderkey ORDER BY l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice) AS INTEGER) AS position,
 l.l_extendedprice / l.l_quantity AS price_usd,
 CASE WHEN l.l_discount >= 0.05 THEN 1 ELSE 0 END AS promotion_flag,
 l.l_suppkey AS srch_destination_id,
 CAST(1 + l.l_orderkey % 7 AS INTEGER) AS srch_length_of_stay, CAST(o.o_custkey % 120 AS INTEGER) AS srch_booking_window,
 CAST(1 + l.l_orderkey % 4 AS INTEGER) AS srch_adults_count, CAST(o.o_custkey % 3 AS INTEGER) AS srch_children_count,
 CAST(1 + l.l_orderkey % 2 AS INTEGER) AS srch_room_count, CASE WHEN l.l_orderkey % 8 >= 4 THEN 1 ELSE 0 END AS srch_saturday_night_bool,
 CASE WHEN (l.l_orderkey + l.l_partkey) % 16 = 0 THEN -1.0 - l.l_tax * 100.0 END AS srch_query_affinity_score,
 CASE WHEN c.c_custkey % 3 <> 0 THEN abs(c.c_acctbal) END AS orig_destination_distance,
 CASE WHEN l.l_orderkey % 3 = 0 THEN 1 ELSE 0 END AS random_bool,
 CASE WHEN (l.l_partkey + 1*l.l_orderkey) % 3 = 0 THEN CAST((l.l_suppkey + 1) % 3 - 1 AS INTEGER) END AS comp1_rate,
 CASE WHEN (l.l_partkey + 1*l.l_orderkey) % 3 <= 1 THEN CAST((l.l_suppkey + 1) % 2 AS INTEGER) END AS comp1_inv,
 CASE WHEN (l.l_partkey + 1*l.l_orderkey) % 3 = 0 THEN CAST((l.l_partkey + 1) % 40 AS DOUBLE) END AS comp1_rate_percent_diff, CASE WHEN (l.l_partkey + 2*l.l_orderkey) % 4 = 0 THEN CAST((l.l_suppkey + 2) % 3 - 1 AS INTEGER) END AS comp2_rate,
 CASE WHEN (l.l_partkey + 2*l.l_orderkey) % 4 <= 1 THEN CAST((l.l_suppkey + 2) % 2 AS INTEGER) END AS comp2_inv,
 CASE WHEN (l.l_partkey + 2*l.l_orderkey) % 4 = 0 THEN CAST((l.l_partkey + 2) % 40 AS DOUBLE) END AS comp2_rate_percent_diff, CASE WHEN (l.l_partkey + 3*l.l_orderkey) % 5 = 0 THEN CAST((l.l_suppkey + 3) % 3 - 1 AS INTEGER) END AS comp3_rate,
 CASE WHEN (l.l_partkey + 3*l.l_orderkey) % 5 <= 1 THEN CAST((l.l_suppkey + 3) % 2 AS INTEGER) END AS comp3_inv,
 CASE WHEN (l.l_partkey + 3*l.l_orderkey) % 5 = 0 THEN CAST((l.l_partkey + 3) % 40 AS DOUBLE) END AS comp3_rate_percent_diff, CASE WHEN (l.l_partkey + 4*l.l_orderkey) % 6 = 0 THEN CAST((l.l_suppkey + 4) % 3 - 1 AS INTEGER) END AS comp4_rate,
 CASE WHEN (l.l_partkey + 4*l.l_orderkey) % 6 <= 1 THEN CAST((l.l_suppkey + 4) % 2 AS INTEGER) END AS comp4_inv,
 CASE WHEN (l.l_partkey + 4*l.l_orderkey) % 6 = 0 THEN CAST((l.l_partkey + 4) % 40 AS DOUBLE) END AS comp4_rate_percent_diff, CASE WHEN (l.l_partkey + 5*l.l_orderkey) % 7 = 0 THEN CAST((l.l_suppkey + 5) % 3 - 1 AS INTEGER) END AS comp5_rate,
 CASE WHEN (l.l_partkey + 5*l.l_orderkey) % 7 <= 1 THEN CAST((l.l_suppkey + 5) % 2 AS INTEGER) END AS comp5_inv,
 CASE WHEN (l.l_partkey + 5*l.l_orderkey) % 7 = 0 THEN CAST((l.l_partkey + 5) % 40 AS DOUBLE) END AS comp5_rate_percent_diff, CASE WHEN (l.l_partkey + 6*l.l_orderkey) % 8 = 0 THEN CAST((l.l_suppkey + 6) % 3 - 1 AS INTEGER) END AS comp6_rate,
 CASE WHEN (l.l_partkey + 6*l.l_orderkey) % 8 <= 1 THEN CAST((l.l_suppkey + 6) % 2 AS INTEGER) END AS comp6_inv,
 CASE WHEN (l.l_partkey + 6*l.l_orderkey) % 8 = 0 THEN CAST((l.l_partkey + 6) % 40 AS DOUBLE) END AS comp6_rate_percent_diff, CASE WHEN (l.l_partkey + 7*l.l_orderkey) % 9 = 0 THEN CAST((l.l_suppkey + 7) % 3 - 1 AS INTEGER) END AS comp7_rate,
 CASE WHEN (l.l_partkey + 7*l.l_orderkey) % 9 <= 1 THEN CAST((l.l_suppkey + 7) % 2 AS INTEGER) END AS comp7_inv,
 CASE WHEN (l.l_partkey + 7*l.l_orderkey) % 9 = 0 THEN CAST((l.l_partkey + 7) % 40 AS DOUBLE) END AS comp7_rate_percent_diff, CASE WHEN (l.l_partkey + 8*l.l_orderkey) % 10 = 0 THEN CAST((l.l_suppkey + 8) % 3 - 1 AS INTEGER) END AS comp8_rate,
 CASE WHEN (l.l_partkey + 8*l.l_orderkey) % 10 <= 1 THEN CAST((l.l_suppkey + 8) % 2 AS INTEGER) END AS comp8_inv,
 CASE WHEN (l.l_partkey + 8*l.l_orderkey) % 10 = 0 THEN CAST((l.l_partkey + 8) % 40 AS DOUBLE) END AS comp8_rate_percent_diff,
 CASE WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'F' THEN 1 ELSE 0 END AS click_bool,
 CASE WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'F' AND l.l_discount >= 0.06 THEN 1 ELSE 0 END AS booking_bool,
 CASE WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'F' AND l.l_discount >= 0.06 THEN l.l_extendedprice END AS gross_bookings_usd
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
JOIN part p ON l.l_partkey = p.p_partkey JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON c.c_nationkey = n.n_nationkey
