"""Planning operators: minimums, demand, loads, cadence, receipts, levelling, schedule."""
