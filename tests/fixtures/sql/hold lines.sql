-- Lines of the window without an export date, by service line
SELECT li_slid, count(*) AS lines_on_hold, min(li_servicedate) AS least, max(li_servicedate) AS most
FROM line_items
WHERE li_ediexportdate IS NULL AND li_servicedate >= :start AND li_servicedate <= :end
GROUP BY li_slid
