"""Shared SQL of the oracle queries: the same claims views as common table expressions."""

RAW = """
claims_raw AS (
  SELECT -o_custkey AS BENE_ID,
         o_orderkey*10+l_linenumber AS CLM_ID,
         c_nationkey+1 AS PRVDR_STATE_CD,
         CASE WHEN l_tax=0.0 AND l_linenumber=3 THEN NULL
              WHEN l_linenumber=7 AND p_size=50 THEN '0FB43ZZ'
              ELSE concat(substr(p_type,1,1), lpad(substr(p_brand,7),2,'0'), CAST(p_size % 10 AS VARCHAR))
         END AS PRNCPAL_DGNS_CD,
         CASE WHEN l_linenumber=5 AND l_discount=0.0 THEN NULL
              WHEN l_linestatus='F' THEN 'Y' ELSE 'U' END AS CLM_E_POA_IND_SW1,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) *
              CASE p_size % 10 WHEN 0 THEN CAST(20.00 AS DECIMAL(4,2))
                               WHEN 1 THEN CAST(0.01 AS DECIMAL(4,2))
                               WHEN 2 THEN CAST(0.01 AS DECIMAL(4,2))
                               WHEN 3 THEN CAST(0.05 AS DECIMAL(4,2))
                               ELSE CAST(1.00 AS DECIMAL(4,2)) END AS DECIMAL(18,2)) AS CLM_TOT_CHRG_AMT,
         CASE WHEN l_returnflag='R' AND o_orderpriority IN ('1-URGENT','2-HIGH') THEN 1
              WHEN l_returnflag<>'R' AND o_orderpriority='5-LOW' THEN 0 END AS PATIENT_TYPE
  FROM lineitem JOIN orders ON l_orderkey=o_orderkey
                JOIN customer ON o_custkey=c_custkey
                JOIN part ON l_partkey=p_partkey),
inp AS (SELECT * REPLACE (abs(BENE_ID) AS BENE_ID, abs(CLM_ID) AS CLM_ID) FROM claims_raw
        WHERE PATIENT_TYPE = 1),
outp AS (SELECT * REPLACE (abs(BENE_ID) AS BENE_ID, abs(CLM_ID) AS CLM_ID) FROM claims_raw
         WHERE PATIENT_TYPE = 0)
"""

INCOME = """
income_text AS (
  SELECT n_nationkey+1 AS PRVDR_STATE_CD, n_name AS STATE,
         CASE WHEN n_nationkey=7 THEN concat('$52,000',chr(160))
              ELSE CAST(45000+1000*n_nationkey AS VARCHAR) END AS Median_Income
  FROM nation WHERE n_nationkey<>24),
income AS (
  SELECT PRVDR_STATE_CD, STATE,
         TRY_CAST(replace(replace(replace(replace(Median_Income,'$',''),',',''),' ',''),chr(160),'')
                  AS DOUBLE) AS Median_Income
  FROM income_text)
"""

MERGED = f"""{RAW},
agg_inp AS (
  SELECT BENE_ID, PRNCPAL_DGNS_CD AS PRNCPAL_DGNS_CD_inp, CLM_E_POA_IND_SW1,
         PRVDR_STATE_CD AS PRVDR_STATE_CD_inp, count(CLM_TOT_CHRG_AMT) AS Number_of_Claims_inp,
         CAST(sum(CLM_TOT_CHRG_AMT) AS DECIMAL(18,2)) AS CLM_TOT_CHRG_AMT_inp
  FROM inp WHERE PRNCPAL_DGNS_CD IS NOT NULL AND CLM_E_POA_IND_SW1 IS NOT NULL
    AND CLM_TOT_CHRG_AMT IS NOT NULL
  GROUP BY 1,2,3,4),
agg_out AS (
  SELECT BENE_ID, PRNCPAL_DGNS_CD AS PRNCPAL_DGNS_CD_out, PRVDR_STATE_CD AS PRVDR_STATE_CD_out,
         count(CLM_TOT_CHRG_AMT) AS Number_of_Claims_out,
         CAST(sum(CLM_TOT_CHRG_AMT) AS DECIMAL(18,2)) AS CLM_TOT_CHRG_AMT_out
  FROM outp WHERE PRNCPAL_DGNS_CD IS NOT NULL GROUP BY 1,2,3),
claims AS (SELECT * FROM agg_inp JOIN agg_out USING (BENE_ID))
"""

MODELING = f"""{MERGED},
{INCOME},
enriched AS (
  SELECT c.*, i.STATE, i.Median_Income FROM claims c
  LEFT JOIN income i ON c.PRVDR_STATE_CD_inp = i.PRVDR_STATE_CD),
modeling AS (
  SELECT *, CAST(CLM_TOT_CHRG_AMT_inp + CLM_TOT_CHRG_AMT_out AS DOUBLE) AS TOTAL_CHARGE,
         ln(CAST(CLM_TOT_CHRG_AMT_inp + CLM_TOT_CHRG_AMT_out AS DOUBLE)) AS LOG_TOTAL_CHARGE,
         CASE WHEN CLM_TOT_CHRG_AMT_inp + CLM_TOT_CHRG_AMT_out <= 1000 THEN 1
              WHEN CLM_TOT_CHRG_AMT_inp + CLM_TOT_CHRG_AMT_out <= 10000 THEN 2
              WHEN CLM_TOT_CHRG_AMT_inp + CLM_TOT_CHRG_AMT_out <= 100000 THEN 3
              WHEN CLM_TOT_CHRG_AMT_inp + CLM_TOT_CHRG_AMT_out <= 1000000 THEN 4
              ELSE 5 END AS TC_class
  FROM enriched),
model_rows AS (
  SELECT * FROM modeling
  WHERE TOTAL_CHARGE > 0 AND Median_Income > 0)
"""

FOLDS = f"""{MODELING},
keys AS (SELECT DISTINCT BENE_ID, md5(concat(CAST(BENE_ID AS VARCHAR), ':42')) AS h FROM model_rows),
key_folds AS (
  SELECT BENE_ID, CASE WHEN row_number() OVER (ORDER BY h) <= ceil(0.3 * count(*) OVER ())
                       THEN 'test' ELSE 'train' END AS fold FROM keys),
folds AS (SELECT m.*, f.fold FROM model_rows m JOIN key_folds f USING (BENE_ID)),
train AS (SELECT * FROM folds WHERE fold='train'),
test AS (SELECT * FROM folds WHERE fold='test')
"""

SCORES = f"""{MODELING},
raw_scores AS (
  SELECT *, 1.0/(1.0+abs(x-0.05)) AS s1, 1.0/(1.0+abs(x-0.5)) AS s2, 1.0/(1.0+abs(x-5.0)) AS s3,
         1.0/(1.0+abs(x-50.0)) AS s4, 1.0/(1.0+abs(x-500.0)) AS s5
  FROM (SELECT *, CAST(CLM_TOT_CHRG_AMT_inp AS DOUBLE)/10000 AS x FROM model_rows)),
scores AS (
  SELECT *, TC_class AS label,
         CASE WHEN CLM_TOT_CHRG_AMT_inp <= 1000 THEN 1 WHEN CLM_TOT_CHRG_AMT_inp <= 10000 THEN 2
              WHEN CLM_TOT_CHRG_AMT_inp <= 100000 THEN 3 WHEN CLM_TOT_CHRG_AMT_inp <= 1000000 THEN 4
              ELSE 5 END AS prediction,
         round(s1/(s1+s2+s3+s4+s5),6) AS p1, round(s2/(s1+s2+s3+s4+s5),6) AS p2,
         round(s3/(s1+s2+s3+s4+s5),6) AS p3, round(s4/(s1+s2+s3+s4+s5),6) AS p4,
         round(s5/(s1+s2+s3+s4+s5),6) AS p5,
         ln(CAST(CLM_TOT_CHRG_AMT_inp AS DOUBLE)*2) AS predicted_log
  FROM raw_scores)
"""
