"""DuckDB SQL for the fixture relations (mirrors ``depreco.sources.fixtures``).

Literals that feed double arithmetic are written as DOUBLE so both engines round the same way.
``{asof}`` is the run's as-of date; dates are computed from it in SQL.
"""

from __future__ import annotations

_TAXONOMY = """CAST(1 + {pk} % 7 AS INTEGER) AS CategoryId,
           CASE WHEN 1 + {pk} % 7 = 7 THEN 'DO NOT USE ' ELSE 'Category ' END || CAST(CAST(1 + {pk} % 7 AS INTEGER) AS VARCHAR) AS CategoryName,
           CAST((1 + {pk} % 7) * 10 + p_size % 3 AS INTEGER) AS SubcategoryId,
           'Subcategory ' || CAST(CAST((1 + {pk} % 7) * 10 + p_size % 3 AS INTEGER) AS VARCHAR) AS SubcategoryName,
           CAST(split_part(p_brand, '#', 2) AS INTEGER) AS MakeId, p_brand AS MakeName"""

_NO_CLASS = "NULL::INTEGER AS MakeId, NULL::VARCHAR AS MakeName, NULL::BIGINT AS ModelId"

FIXTURES = [
    ("sold", f"""
    SELECT l.l_orderkey, l.l_partkey, l.l_linenumber, l.l_quantity, l.l_discount + 0.0::DOUBLE AS dsc, l.l_tax + 0.0::DOUBLE AS tax,
           l.l_returnflag, l.l_linestatus, CAST(l.l_shipdate AS DATE) AS SaleDate, p.p_name AS ModelName, l.l_partkey AS ModelId,
           CASE WHEN l.l_partkey % 41 = 0 THEN 4.0::DOUBLE WHEN l.l_partkey % 43 = 0 THEN 8.0::DOUBLE ELSE p.p_retailprice END AS Cost,
           {_TAXONOMY.format(pk='l.l_partkey')},
           CASE WHEN 1 + l.l_partkey % 7 = 5 AND l.l_partkey % 20 <> 0 THEN 1995
                ELSE CAST(1986 + (l.l_partkey // 5) % 12 AS INTEGER) END AS ModelYear
    FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey"""),
    ("cost_assets", """
    SELECT s.l_orderkey * 10 + s.l_linenumber AS CustomerAssetId, o.o_custkey AS CustomerId,
           'Customer#' || CAST(o.o_custkey AS VARCHAR) AS CustomerName,
           CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_linenumber AS VARCHAR) || l_returnflag || l_linestatus
                ELSE l_returnflag || CAST(l_linenumber AS VARCHAR) || l_linestatus END AS EquipNo,
           CategoryId, CategoryName, CASE WHEN l_partkey % 53 <> 0 THEN SubcategoryId END AS SubcategoryId, SubcategoryName,
           MakeId, MakeName, ModelId, ModelName, ModelYear,
           CASE WHEN l_orderkey % 61 = 0 THEN CAST(CAST(o.o_orderdate AS DATE) - INTERVAL 180 MONTH AS DATE)
                ELSE CAST(o.o_orderdate AS DATE) END AS AcquisitionDate,
           Cost,
           CASE WHEN l_orderkey % 37 <> 0 THEN Cost * (
               CASE WHEN l_quantity = 1 THEN 0.7::DOUBLE WHEN l_quantity = 50 AND l_linenumber <= 2 THEN 1.6::DOUBLE
                    ELSE 1.0::DOUBLE + 0.004::DOUBLE * l_quantity
                         + (CASE WHEN CategoryId = 5 THEN 0.35::DOUBLE WHEN CategoryId = 1 THEN -0.1::DOUBLE ELSE 0.0::DOUBLE END) END) END AS CurrentABCostUSNA,
           CASE WHEN l_linenumber < 7 THEN 'Y' ELSE 'N' END AS IsUsedForABCostUSNA,
           CASE WHEN l_linestatus = 'F' AND l_linenumber = 1 THEN 'Y' ELSE 'N' END AS IsPurchasedUsed
    FROM sold s JOIN orders o ON s.l_orderkey = o.o_orderkey"""),
    ("comparables", """
    SELECT CategoryId, CategoryName, CASE WHEN l_partkey % 53 <> 0 THEN SubcategoryId END AS SubcategoryId, SubcategoryName,
           MakeId, MakeName, ModelName, ModelYear, SaleDate, CAST(year(SaleDate) AS INTEGER) AS SaleYear,
           Cost * (0.35::DOUBLE + 5.0::DOUBLE * dsc + 2.0::DOUBLE * tax)
             * (CASE WHEN CategoryId = 2 AND SaleDate > DATE '2001-05-31' THEN 0.7::DOUBLE ELSE 1.0::DOUBLE END) AS SalePrice,
           Cost, Cost * (0.4::DOUBLE + 0.04::DOUBLE * l_quantity) AS CurrentABCostUSNA, Cost * 0.6::DOUBLE AS M1PrecedingFmv,
           CASE WHEN l_returnflag = 'R' OR s.SubcategoryId = 32 OR CategoryId = 4 THEN 'Auction' ELSE 'Retail' END AS saletype,
           CASE WHEN l_linenumber < 7 THEN 'Y' ELSE 'N' END AS IsUsedForComparablesUSNA
    FROM sold s"""),
    ("catalogue", f"SELECT DISTINCT {_TAXONOMY.format(pk='p_partkey')} FROM part"),
    ("classifications", f"""
    SELECT DISTINCT CAST(100 + CategoryId AS INTEGER) AS ClassificationId, CategoryId, CategoryName,
           NULL::INTEGER AS SubcategoryId, NULL::VARCHAR AS SubcategoryName, {_NO_CLASS} FROM catalogue
    UNION ALL
    SELECT DISTINCT CAST(1000 + SubcategoryId AS INTEGER), CategoryId, CategoryName, SubcategoryId, SubcategoryName, {_NO_CLASS} FROM catalogue
    UNION ALL
    SELECT DISTINCT CAST(100000 + SubcategoryId * 100 + MakeId AS INTEGER), CategoryId, CategoryName, SubcategoryId, SubcategoryName,
           MakeId, MakeName, NULL::BIGINT FROM catalogue"""),
    ("values_of_rows", f"""
    WITH v AS (
      SELECT *, last_day(SaleDate) AS pub, 100.0::DOUBLE * (0.30::DOUBLE + 5.0::DOUBLE * dsc) AS flv,
             100.0::DOUBLE * (0.45::DOUBLE + 5.0::DOUBLE * dsc + tax) AS fmv FROM sold)
    SELECT CAST(100 + CategoryId AS INTEGER) AS ClassificationId, CategoryId, CategoryName,
           NULL::INTEGER AS SubcategoryId, NULL::VARCHAR AS SubcategoryName, {_NO_CLASS}, ModelYear, pub, flv, fmv FROM v
    UNION ALL
    SELECT CAST(1000 + SubcategoryId AS INTEGER), CategoryId, CategoryName, SubcategoryId, SubcategoryName, {_NO_CLASS}, ModelYear, pub, flv, fmv FROM v
    UNION ALL
    SELECT CAST(100000 + SubcategoryId * 100 + MakeId AS INTEGER), CategoryId, CategoryName, SubcategoryId, SubcategoryName,
           MakeId, MakeName, NULL::BIGINT, ModelYear, pub, flv, fmv FROM v
    UNION ALL
    SELECT CAST(10000000 + l_partkey AS INTEGER), CategoryId, CategoryName, SubcategoryId, SubcategoryName,
           MakeId, MakeName, l_partkey, ModelYear, pub, flv, fmv FROM v"""),
    ("class_values", """
    SELECT ClassificationId, CategoryId, CategoryName, SubcategoryId, SubcategoryName, MakeId, MakeName, ModelId,
           ModelYear, CAST(year(pub) AS INTEGER) AS PublishYear, pub AS AppraisalBookPublishDate,
           CASE WHEN (ClassificationId + month(pub)) % 31 <> 0 THEN avg(flv) END AS FlvSchedulePercentage, avg(fmv) AS FmvSchedulePercentage
    FROM values_of_rows
    GROUP BY ClassificationId, CategoryId, CategoryName, SubcategoryId, SubcategoryName, MakeId, MakeName, ModelId, ModelYear, pub"""),
    ("class_values_in_progress", """
    SELECT * EXCLUDE (AppraisalBookPublishDate, PublishYear) FROM class_values
    WHERE AppraisalBookPublishDate = last_day({asof} - INTERVAL 1 MONTH)"""),
    ("mapped", """
    SELECT ClassificationId, CategoryId, CategoryName, SubcategoryId, SubcategoryName, MakeId, MakeName,
           CASE WHEN SubcategoryId IS NULL THEN 'Category' WHEN MakeId IS NULL THEN 'SubcatGroup' ELSE 'Make' END AS Level2,
           CASE WHEN SubcategoryId IS NULL THEN 'C ' WHEN MakeId IS NULL THEN 'CS ' ELSE 'M ' END
             || CAST(ClassificationId AS VARCHAR) AS Schedule
    FROM classifications WHERE MakeId IS NULL OR MakeId % 5 <> 0"""),
    ("in_map", """
    SELECT 'USA' AS Country, Schedule, Level2, CategoryId, SubcategoryId, MakeId, ClassificationId, SubcategoryName FROM mapped
    UNION ALL
    SELECT 'CAN', Schedule || ' CAN', Level2, CategoryId, SubcategoryId, MakeId, ClassificationId, SubcategoryName FROM mapped WHERE Level2 = 'Category'
    UNION ALL
    SELECT 'USA', 'CS none', 'SubcatGroup', CategoryId, SubcategoryId, MakeId, NULL, SubcategoryName FROM mapped WHERE Level2 = 'Category' AND CategoryId = 1"""),
    ("in_borrow_map", """
    SELECT 'USA' AS Country, 'RS RbA ' || CAST(ClassificationId AS VARCHAR) AS Schedule, 'SubcatGroup' AS Level2,
           CategoryId, SubcategoryId, NULL::INTEGER AS MakeId, 'RetailBorrowAuction' AS BorrowType
    FROM classifications WHERE SubcategoryId % 10 = 1 AND MakeId IS NULL
    UNION ALL
    SELECT 'USA', 'CA AbR ' || CAST(ClassificationId AS VARCHAR), 'Category', CategoryId, NULL, NULL, 'AuctionBorrowRetail'
    FROM classifications WHERE SubcategoryId IS NULL"""),
    ("out_map", """
    SELECT Country, ClassificationId, Schedule, SubcategoryId, SubcategoryName, Level2, 'Y' AS Plot FROM in_map WHERE ClassificationId IS NOT NULL
    UNION ALL SELECT Country, ClassificationId, Schedule, SubcategoryId, SubcategoryName, 'Category', 'N' FROM in_map WHERE Level2 = 'SubcatGroup' AND CategoryId = 3
    UNION ALL SELECT Country, CAST(9000000 + ClassificationId AS INTEGER), 'none ' || CAST(CategoryId AS VARCHAR), SubcategoryId, SubcategoryName, Level2, 'Y'
              FROM in_map WHERE Level2 = 'Category' AND CategoryId = 2"""),
    ("out_borrow_map", """
    SELECT 'USA' AS Country, k.ClassificationId,
           CASE WHEN k.MakeId = 6 THEN 'RS ' ELSE 'RS RbA ' END || CAST(g.ClassificationId AS VARCHAR) AS Schedule,
           k.SubcategoryId, k.SubcategoryName, 'Make' AS Level2, 'Y' AS Plot
    FROM classifications k JOIN classifications g ON g.SubcategoryId = k.SubcategoryId AND g.MakeId IS NULL
    WHERE k.MakeId IN (4, 5, 6) AND g.SubcategoryId % 10 = 1"""),
    ("last_month_factors", """
    SELECT 'USNA' AS MarketCode, ClassificationId, CategoryId, CategoryName, SubcategoryId, SubcategoryName, MakeId, MakeName,
           1.0::DOUBLE + CAST(ClassificationId % 25 AS DOUBLE) * 0.01::DOUBLE + bump AS ResidSf,
           1.0::DOUBLE + CAST(ClassificationId % 25 AS DOUBLE) * 0.01::DOUBLE + bump AS RetailEconSfBest,
           0.8::DOUBLE + CAST(ClassificationId % 20 AS DOUBLE) * 0.01::DOUBLE + bump AS RetailEconSfWorst,
           1.0::DOUBLE + CAST(ClassificationId % 25 AS DOUBLE) * 0.01::DOUBLE + bump AS AuctionEconSfBest,
           0.8::DOUBLE + CAST(ClassificationId % 20 AS DOUBLE) * 0.01::DOUBLE + bump AS AuctionEconSfWorst,
           CAST(year(pub) * 100 + month(pub) AS INTEGER) AS AppraisalBookIssueID, pub AS AppraisalBookPublishDate
    FROM classifications, (SELECT last_day({asof} - INTERVAL 2 MONTH) AS pub, 0.0::DOUBLE AS bump
                           UNION ALL SELECT last_day({asof} - INTERVAL 3 MONTH), 0.05::DOUBLE) m
    WHERE ClassificationId % 7 <> 0"""),
]
