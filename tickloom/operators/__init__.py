"""Operators on market-data series. Series are partitioned by month (and by further keys, if any): every
window of the engine has those keys, so months run in parallel and none needs the whole series."""
