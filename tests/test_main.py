from daybook.__main__ import main


def test_the_four_jobs_from_the_command_line(spark, tmp_path, capsys):
    root = str(tmp_path / "store")
    schema = ["--schema", "id string, name string, city string"]
    for day, text in (("2025-01-01", "1,a,x\n2,b,x\n"), ("2025-01-02", "1,a,y\n3,c,x\n")):
        csv = tmp_path / f"{day}.csv"
        csv.write_text("id,name,city\n" + text)
        for _ in range(2):
            main(["daily-integration", day, str(csv), "--root", root, *schema])
        main(["recompute-dump", day, str(tmp_path / day), "--root", root])
    main(["report", "--root", root, "--by", "city"])
    main(["diff", str(tmp_path / "2025-01-01"), str(tmp_path / "2025-01-02")])
    main(["recompute-dump", "2024-01-01", str(tmp_path / "none"), "--root", root])
    out = capsys.readouterr().out
    assert out.count("integrated 2025") == 2 and out.count("skipped") == 2
    for line in ("|x   |1    |", "|3  |c   |x   |I  |", "|1  |a   |y   |U  |", "|2  |b   |x   |D  |", "nothing written"):
        assert line in out
