"""The registered queries, the SQL that checks them, and the mail they read."""
