-- Two statements; the literal holds a semicolon.
CREATE OR REPLACE TEMPORARY VIEW rm_segment AS
SELECT c_mktsegment, CONCAT(c_mktsegment, ';') AS tag, c_acctbal FROM IDENTIFIER(:source);
CREATE OR REPLACE TEMPORARY VIEW rm_segment_totals AS
SELECT tag, COUNT(*) AS cnt, MAX(c_acctbal) AS best FROM rm_segment GROUP BY tag; /* end; */
