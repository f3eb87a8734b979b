"""The datasets: raw captures, typed prices, derived views, reports and monitors."""
