"""The driver tables read as ledgers, rollups, claims and rulings, and the queries over them."""
