"""Where items come from: tables, archives and the id frontier."""
