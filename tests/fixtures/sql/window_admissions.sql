/* Admissions in the run window (Spark SQL over the catalog views).
   Run dates are bound by the runner as :start / :end / :as_of. */
DECLARE @StartDate date = DATEADD(DAY, -14, GETDATE());
DECLARE @EndDate date = GETDATE();

SELECT epi_slid, COUNT(*) AS admission_count
FROM episodes
WHERE epi_status = 'CURRENT'
  AND epi_NonAdmitDate IS NULL
  AND CAST(epi_SocDate AS DATE) BETWEEN :start AND :end   -- date-inclusive window
GROUP BY epi_slid;

SELECT epi_AdmitType, COUNT(*) AS admissions_all_types
FROM episodes
WHERE CAST(epi_SocDate AS DATE) BETWEEN :start AND :end
GROUP BY epi_AdmitType;
