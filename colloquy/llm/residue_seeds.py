"""Seeds of the models in residue.py, written from general knowledge of web servers, browsers, publishing systems and
template languages, without a look at any test table. Phrases are put together by rule from the parts below."""

from __future__ import annotations

from itertools import chain, product

LANGUAGES = ("vi", "en", "es", "ja")


def _lines(text: str) -> list[str]:
    return [x.strip() for x in text.strip().split("\n")]


def _parts(text: str) -> list[str]:
    return [x.strip() for x in text.replace("\n", " ").split(";") if x.strip()]


#: Status codes of HTTP with their reason phrases.
STATUS = """400 Bad Request; 401 Unauthorized; 402 Payment Required; 403 Forbidden; 404 Not Found; 405 Method Not Allowed;
 406 Not Acceptable; 408 Request Timeout; 409 Conflict; 410 Gone; 413 Content Too Large; 414 URI Too Long;
 415 Unsupported Media Type; 418 I'm a teapot; 421 Misdirected Request; 422 Unprocessable Content; 423 Locked; 425 Too Early;
 429 Too Many Requests; 431 Request Header Fields Too Large; 451 Unavailable For Legal Reasons; 500 Internal Server Error;
 501 Not Implemented; 502 Bad Gateway; 503 Service Unavailable; 504 Gateway Timeout; 505 HTTP Version Not Supported;
 507 Insufficient Storage; 508 Loop Detected; 511 Network Authentication Required"""

#: What a notice is about, what is wrong with it, what to do, and other words of error pages; then notices on scripts:
#: what to do, with what, to what end, and statements; then the furniture of a page.
NOTICE = {
    "en": {
        "pattern": ("The {0} {1}.", "This {0} {1}.", "Sorry, the {0} {1}."),
        "things": "page; page you requested; site; website; file; link; article; document; video; audio; recording; episode; show; feed; stream; player; server; service; resource; content; address; account; request; image; playlist; transcript; download; domain; application; database",
        "faults": """could not be found; was not found on this server; is not available; is no longer available; is temporarily unavailable; has been removed;
         has been deleted by its owner; has moved to a new address; has been taken down; has been suspended; has been disabled; does not exist; may have expired;
         has expired; cannot be displayed; cannot be reached; cannot be opened; could not be loaded; could not be processed; could not be verified; failed to load;
         failed to start; did not respond in time; took too long; timed out; is currently offline; is down for maintenance; is overloaded right now;
         is experiencing technical difficulties; is restricted in your region; is not offered in your country; is blocked by the administrator; is private; is only open to subscribers;
         requires you to log in; returned an unexpected response; is broken; is empty; is corrupted; has used up its quota; is not supported by your device""",
        "remedies": """Please try again later.; Please wait a moment and reload.; Refresh the page or come back in an hour.; Check the spelling of the address.; Check your internet connection.;
         Go back to the home page.; Return to the previous page.; Contact the webmaster if the problem persists.; Contact customer support and give this reference number.; Please log in to continue.;
         Create an account to get access.; Clear your cookies and cache.; Complete the captcha to prove that you are human.; Update your browser to a newer version.; We apologise for the inconvenience.;
         We are working on a fix.; Our engineers have been informed.; Use the search box to find what you need.; If you believe this is a mistake, let us know.; Thank you for your patience.""",
        "phrases": """Something went wrong; An unexpected error has occurred; An error occurred while processing your request; Oops! We can't find that; Whoops, that did not work; Fatal error: uncaught exception in line 12;
         Internal error, see the log; Could not connect to the database; Access is denied; You are not authorised to see this; Permission denied; Too many attempts; Rate limit reached; Invalid request;
         Missing parameter; Connection refused; Connection reset by peer; Network error; Gateway timeout; The certificate is not valid; You have been logged out; Your session is invalid; Verification failed; Unknown host;
         DNS lookup failed; null pointer exception; undefined is not a function; Traceback (most recent call last); segmentation fault; no such file or directory; This domain is parked; Under construction;
         Scheduled maintenance in progress; Service interruption; Unable to load; Unable to play this media; Playback error; Loading failed; error code; reference; request id; status code; Incident number;
         Security check; Verify you are human; Subscribe to read on; Members only; Server error; Page not found; Syntax error; Warning: cannot modify header information; Module not installed; Missing file""",
        "do": "Enable; Please enable; Turn on; Please turn on; Switch on; Allow; Activate; You must enable; Unblock; You have to allow; Reactivate",
        "scripts": "JavaScript; scripts; scripting; JS; JavaScript and cookies; active scripts",
        "ends": "in your browser; to continue; to view this page; to use this website; to play the audio; and reload; and then refresh; for the player to work; in the settings; to see the content; to run this app",
        "statements": """JavaScript is disabled; JavaScript is turned off in your browser; JavaScript is not enabled; JavaScript is required; JavaScript must be on; This site requires JavaScript; This website needs scripts to run;
         This application relies on JavaScript; It will not work without JavaScript; The player does not work without scripts; Your browser does not support scripts; Your browser has scripts disabled; Your browser blocks JavaScript; Scripts seem to be blocked;
         You need a browser that runs scripts; An extension or ad blocker is stopping our scripts; noscript; Without scripts nothing can be shown here""",
        "furniture": "Home; About; About us; Contact; Search; Log in; Sign up; Menu; Help; FAQ; Privacy policy; Terms of use; Back to top; Skip to content; All rights reserved; Cookie settings; Site map; Support; Previous; Next; Share; Archive; Categories",
    },
    "vi": {
        "pattern": ("{0} {1}.", "Rất tiếc, {0} {1}.", "Xin lỗi, {0} này {1}."),
        "things": "trang; trang bạn yêu cầu; trang web; website; tệp; tập tin; liên kết; đường dẫn; bài viết; tài liệu; video; âm thanh; bản ghi âm; tập phát; chương trình; nguồn tin; luồng phát; trình phát; máy chủ; dịch vụ; tài nguyên; nội dung; địa chỉ; tài khoản; yêu cầu; hình ảnh; danh sách phát; bản tải về; tên miền; ứng dụng; cơ sở dữ liệu",
        "faults": """không tìm thấy; không được tìm thấy trên máy chủ; không có sẵn; không còn nữa; không tồn tại; không còn tồn tại; tạm thời không truy cập được; tạm ngừng hoạt động; đã bị xoá; đã bị gỡ bỏ;
         đã được chủ sở hữu xoá; đã chuyển sang địa chỉ mới; đã bị khoá; đã bị vô hiệu hoá; đã hết hạn; có thể đã hết hiệu lực; không thể hiển thị; không thể mở; không thể kết nối; không thể tải; không thể phát; không xử lý được;
         tải thất bại; không phản hồi; phản hồi quá lâu; quá thời gian chờ; đang ngoại tuyến; đang bảo trì; đang quá tải; đang gặp sự cố kỹ thuật; bị hạn chế ở khu vực của bạn; không hỗ trợ tại quốc gia của bạn;
         bị quản trị viên chặn; ở chế độ riêng tư; chỉ dành cho người đăng ký; yêu cầu bạn đăng nhập; trả về kết quả không hợp lệ; bị hỏng; trống; đã vượt quá hạn mức; không tương thích với thiết bị của bạn""",
        "remedies": """Vui lòng thử lại sau.; Vui lòng chờ giây lát rồi tải lại.; Hãy tải lại trang hoặc quay lại sau.; Kiểm tra lại địa chỉ đã nhập.; Kiểm tra kết nối mạng của bạn.; Quay về trang chủ.; Trở lại trang trước.;
         Liên hệ quản trị viên nếu sự cố tiếp diễn.; Liên hệ bộ phận hỗ trợ và gửi kèm mã tham chiếu.; Vui lòng đăng nhập để tiếp tục.; Tạo tài khoản để truy cập.; Xoá cookie và bộ nhớ đệm.; Nhập mã xác nhận để chứng minh bạn là con người.;
         Cập nhật trình duyệt lên phiên bản mới.; Xin lỗi vì sự bất tiện này.; Chúng tôi đang khắc phục.; Kỹ thuật viên đã được thông báo.; Dùng ô tìm kiếm để tìm nội dung bạn cần.; Cảm ơn bạn đã kiên nhẫn.""",
        "phrases": """Đã có lỗi xảy ra; Có lỗi không mong muốn; Lỗi khi xử lý yêu cầu; Ôi hỏng rồi; Lỗi hệ thống; Lỗi máy chủ; Lỗi nội bộ; Lỗi kết nối; Lỗi mạng; Lỗi phát lại; Lỗi tải trang; Lỗi xác thực; Không kết nối được cơ sở dữ liệu; Không có quyền truy cập; Bạn không được phép xem;
         Từ chối quyền; Quá nhiều lần thử; Quá nhiều yêu cầu; Yêu cầu không hợp lệ; Thiếu tham số; Kết nối bị từ chối; Hết thời gian kết nối; Chứng chỉ không hợp lệ; Bạn đã bị đăng xuất; Phiên làm việc không hợp lệ; Xác minh thất bại;
         Không tìm thấy tệp; Tên miền chưa được kích hoạt; Trang đang xây dựng; Đang bảo trì định kỳ; Gián đoạn dịch vụ; Không tải được; Không phát được; mã lỗi; mã yêu cầu; mã trạng thái; số sự cố; Kiểm tra bảo mật; Đăng ký để đọc tiếp; Dành riêng cho hội viên; Cú pháp sai""",
        "do": "Bật; Vui lòng bật; Hãy bật; Kích hoạt; Hãy kích hoạt; Cho phép; Bạn cần bật; Bạn phải cho phép; Bỏ chặn; Mở lại",
        "scripts": "JavaScript; tập lệnh; script; JS; JavaScript và cookie; kịch bản JavaScript",
        "ends": "trong trình duyệt; để tiếp tục; để xem trang này; để dùng trang web này; để nghe âm thanh; rồi tải lại trang; rồi làm mới; để trình phát hoạt động; trong phần cài đặt; để xem nội dung; để chạy ứng dụng",
        "statements": """JavaScript đang bị tắt; JavaScript đã bị tắt trong trình duyệt của bạn; JavaScript chưa được bật; Cần có JavaScript; Trang web này cần JavaScript; Ứng dụng cần chạy tập lệnh; Không hoạt động nếu thiếu JavaScript; Trình phát không chạy khi tắt tập lệnh;
         Trình duyệt không hỗ trợ tập lệnh; Trình duyệt của bạn đã tắt tập lệnh; Trình duyệt đang chặn JavaScript; Có vẻ tập lệnh đang bị chặn; Bạn cần một trình duyệt chạy được tập lệnh; Tiện ích chặn quảng cáo đang ngăn tập lệnh; Không có tập lệnh thì không hiển thị được gì""",
        "furniture": "Trang chủ; Giới thiệu; Về chúng tôi; Liên hệ; Tìm kiếm; Đăng nhập; Đăng ký; Trình đơn; Trợ giúp; Câu hỏi thường gặp; Chính sách riêng tư; Điều khoản sử dụng; Lên đầu trang; Bỏ qua đến nội dung; Bản quyền; Cài đặt cookie; Sơ đồ trang; Hỗ trợ; Trước; Sau; Chia sẻ; Lưu trữ; Danh mục",
    },
    "es": {
        "pattern": ("{0} {1}.", "Lo sentimos, {0} {1}."),
        "things": "la página; la página solicitada; el sitio; el sitio web; el archivo; el enlace; el artículo; el documento; el vídeo; el audio; la grabación; el episodio; el programa; el canal; la emisión; el reproductor; el servidor; el servicio; el recurso; el contenido; la dirección; la cuenta; la solicitud; la imagen; la lista; la transcripción; la descarga; el dominio; la aplicación; la base de datos",
        "faults": """no se ha encontrado; no se encuentra en este servidor; no está disponible; ya no está disponible; no está disponible temporalmente; no existe; ya no existe; se ha borrado; fue retirado por su propietario; ha cambiado de dirección; se ha suspendido; se ha desactivado;
         ha caducado; puede haber caducado; no se puede mostrar; no se puede abrir; no se puede reproducir; no se pudo cargar; no se pudo procesar; no se pudo verificar; no carga; no responde; tarda demasiado en responder; agotó el tiempo de espera; está fuera de línea; está en mantenimiento;
         está saturado en este momento; tiene problemas técnicos; está restringido en tu región; no se ofrece en tu país; está bloqueado por el administrador; es privado; es solo para suscriptores; requiere iniciar sesión; devolvió una respuesta inesperada; está dañado; está vacío; ha superado su cuota; no es compatible con tu dispositivo""",
        "remedies": """Inténtalo de nuevo más tarde.; Espera un momento y vuelve a cargar.; Actualiza la página o vuelve dentro de una hora.; Comprueba que la dirección esté bien escrita.; Comprueba tu conexión a internet.; Volver a la página de inicio.; Regresa a la página anterior.; Contacta con el administrador si el problema continúa.;
         Escribe al servicio técnico e indica este número de referencia.; Inicia sesión para continuar.; Crea una cuenta para acceder.; Borra las cookies y la caché.; Completa el captcha para demostrar que eres una persona.; Actualiza tu navegador a una versión más reciente.; Disculpa las molestias.; Estamos trabajando para solucionarlo.;
         Nuestro equipo ya está avisado.; Usa el buscador para encontrar lo que necesitas.; Gracias por tu paciencia.""",
        "phrases": """Algo salió mal; Ha ocurrido un error inesperado; Error al procesar la solicitud; Vaya, no encontramos eso; Error fatal; Error interno; Error del servidor; Error de conexión; Error de red; Error de reproducción; No se pudo conectar con la base de datos; Acceso prohibido; No tienes autorización para ver esto; Permiso denegado; Demasiados intentos; Demasiadas solicitudes;
         Solicitud no válida; Falta un parámetro; Conexión rechazada; Tiempo de espera agotado; El certificado no es válido; Se ha cerrado tu sesión; La sesión no es válida; Falló la verificación; Archivo inexistente; Dominio sin activar; Sitio en construcción; Mantenimiento programado; Interrupción del servicio; No se puede cargar; código de error; referencia; código de estado; número de incidencia;
         Control de seguridad; Verifica que eres humano; Suscríbete para seguir leyendo; Solo socios; Página no encontrada; Error de sintaxis""",
        "do": "Activa; Por favor, activa; Habilita; Debes habilitar; Permite; Enciende; Tienes que permitir; Desbloquea; Vuelve a activar",
        "scripts": "JavaScript; los scripts; las secuencias de comandos; JS; JavaScript y las cookies; los guiones activos",
        "ends": "en tu navegador; para continuar; para ver esta página; para usar este sitio; para escuchar el audio; y recarga; y actualiza; para que funcione el reproductor; en los ajustes; para ver el contenido; para ejecutar la aplicación",
        "statements": """JavaScript está desactivado; JavaScript está deshabilitado en tu navegador; JavaScript no está activado; Se necesita JavaScript; Este sitio requiere JavaScript; Esta web necesita scripts para funcionar; La aplicación depende de JavaScript; No funciona sin JavaScript; El reproductor no funciona sin scripts; Tu navegador no admite scripts;
         Tu navegador tiene los scripts desactivados; El navegador está bloqueando JavaScript; Parece que los scripts están bloqueados; Hace falta un navegador que ejecute scripts; Un bloqueador de anuncios impide nuestros scripts; Sin scripts no se puede mostrar nada""",
        "furniture": "Inicio; Acerca de; Quiénes somos; Contacto; Buscar; Iniciar sesión; Registrarse; Menú; Ayuda; Preguntas frecuentes; Política de privacidad; Condiciones de uso; Volver arriba; Saltar al contenido; Todos los derechos reservados; Configurar cookies; Mapa del sitio; Soporte; Anterior; Siguiente; Compartir; Archivo; Categorías",
    },
    "ja": {
        "pattern": ("{0}{1}。", "申し訳ありませんが、{0}{1}。", "この{0}{1}。"),
        "things": "ページ; ご指定のページ; サイト; ウェブサイト; ファイル; リンク; 記事; 文書; 動画; 音声; 録音; エピソード; 番組; フィード; 配信; プレーヤー; サーバー; サービス; リソース; コンテンツ; アドレス; アカウント; リクエスト; 画像; 再生リスト; 文字起こし; ダウンロード; ドメイン; アプリ; データベース",
        "faults": """は見つかりませんでした; が見つかりません; は存在しません; は現在ご利用いただけません; は利用できません; は一時的に利用できません; は公開を終了しました; は削除されています; は所有者によって削除されました; は別の場所に移動しました; は停止されています; は無効になっています; の有効期限が切れています; は期限切れの可能性があります;
         を表示できません; を開けません; を再生できません; の読み込みに失敗しました; を読み込めません; を処理できませんでした; を確認できませんでした; が応答しません; の応答に時間がかかっています; がタイムアウトしました; はオフラインです; はメンテナンス中です; は混み合っています; に技術的な問題が発生しています; はお使いの地域では制限されています;
         はお客様の国では提供していません; は管理者によってブロックされています; は非公開です; は購読者限定です; にはログインが必要です; から予期しない応答がありました; が壊れています; は空です; は上限を超えました; はお使いの端末に対応していません""",
        "remedies": """時間をおいて再度お試しください。; しばらく待ってから再読み込みしてください。; ページを更新してください。; アドレスが正しいかご確認ください。; インターネット接続をご確認ください。; トップページへ戻る。; 前のページに戻ってください。; 問題が続く場合は管理者にご連絡ください。; 参照番号を添えてサポートまでお問い合わせください。; 続行するにはログインしてください。;
         アカウントを作成してください。; クッキーとキャッシュを消去してください。; 人間であることを確認してください。; ブラウザを最新版に更新してください。; ご不便をおかけして申し訳ございません。; 現在復旧作業を行っています。; 担当者に通知しました。; 検索ボックスからお探しください。; ご理解のほどお願いいたします。""",
        "phrases": """問題が発生しました; 予期しないエラーが発生しました; 処理中にエラーが発生しました; 致命的なエラー; 内部エラー; サーバーエラー; 接続エラー; ネットワークエラー; 再生エラー; 読み込みエラー; データベースに接続できません; アクセスできません; 閲覧する権限がありません; 許可されていません; 試行回数が多すぎます; リクエストが多すぎます; 不正なリクエストです; パラメータがありません; 接続が拒否されました;
         接続がタイムアウトしました; 証明書が無効です; ログアウトしました; セッションが無効です; 認証に失敗しました; ファイルがありません; 工事中; 定期メンテナンスのお知らせ; サービスを停止しています; 読み込めません; エラーコード; 参照番号; ステータスコード; お問い合わせ番号; セキュリティチェック; 続きを読むには登録が必要です; 会員専用; 構文エラー""",
        "do": "JavaScriptを; スクリプトを; ブラウザのJavaScriptを; JSを; JavaScriptとクッキーを; ブラウザの設定でスクリプトを",
        "scripts": "有効にして; オンにして; 許可して; 有効化して; 使えるようにして",
        "ends": "ください; 続行してください; から再読み込みしてください; ご覧ください; 再度お試しください; このサイトをご利用ください; 再生してください",
        "statements": """JavaScriptが無効です; JavaScriptが無効になっているようです; JavaScriptが必要です; このサイトはJavaScriptを使用しています; スクリプトがオフになっています; スクリプトが無効のため表示できません; スクリプトがブロックされています; ブラウザがスクリプトに対応していません; JavaScriptなしでは動作しません; 広告ブロックがスクリプトを妨げています; スクリプトを実行できるブラウザが必要です; プレーヤーの動作にはスクリプトが必要です""",
        "furniture": "ホーム; 会社概要; お問い合わせ; 検索; ログイン; 新規登録; メニュー; ヘルプ; よくある質問; プライバシーポリシー; 利用規約; ページの先頭へ; 本文へ移動; 著作権; クッキー設定; サイトマップ; サポート; 前へ; 次へ; 共有; アーカイブ; カテゴリー",
    },
}

#: The usual dummy text, from Cicero's De finibus, and the words of its generators.
LATIN = """
Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor incididunt ut labore et dolore magna aliqua.
Ut enim ad minim veniam, quis nostrud exercitation ullamco laboris nisi ut aliquip ex ea commodo consequat.
Duis aute irure dolor in reprehenderit in voluptate velit esse cillum dolore eu fugiat nulla pariatur.
Excepteur sint occaecat cupidatat non proident, sunt in culpa qui officia deserunt mollit anim id est laborum.
Sed ut perspiciatis unde omnis iste natus error sit voluptatem accusantium doloremque laudantium, totam rem aperiam, eaque ipsa quae ab illo inventore veritatis et quasi architecto beatae vitae dicta sunt explicabo.
Nemo enim ipsam voluptatem quia voluptas sit aspernatur aut odit aut fugit, sed quia consequuntur magni dolores eos qui ratione voluptatem sequi nesciunt.
Neque porro quisquam est, qui dolorem ipsum quia dolor sit amet, consectetur, adipisci velit, sed quia non numquam eius modi tempora incidunt ut labore et dolore magnam aliquam quaerat voluptatem.
At vero eos et accusamus et iusto odio dignissimos ducimus qui blanditiis praesentium voluptatum deleniti atque corrupti quos dolores et quas molestias excepturi sint occaecati cupiditate non provident.
Curabitur vestibulum pellentesque habitant morbi tristique senectus netus et malesuada fames ac turpis egestas. Vivamus suscipit tortor eget felis porttitor volutpat. Praesent sapien massa, convallis a nec, egestas non nisi.
Nulla facilisi. Integer lacinia sollicitudin massa. Cras metus. Sed aliquet risus a tortor. Integer id quam. Morbi mi. Quisque nisl felis, venenatis tristique, dignissim in, ultrices sit amet, augue. Proin sodales libero eget ante.
Nulla quam. Aenean laoreet. Vestibulum nisi lectus, commodo ac, facilisis ac, ultricies eu, pede. Ut orci risus, accumsan porttitor, cursus quis, aliquet eget, justo. Sed pretium blandit orci. Ut eu diam at pede suscipit sodales.
Aenean lectus elit, fermentum non, convallis id, sagittis at, neque. Nullam mauris orci, aliquet et, iaculis et, viverra vitae, ligula. Nulla ut felis in purus aliquam imperdiet. Maecenas aliquet mollis lectus. Vivamus consectetuer risus et tortor.
Phasellus fermentum, urna nec bibendum luctus, nibh eros hendrerit arcu, donec varius lorem velit gravida mattis. Etiam tincidunt, semper rutrum, tempus efficitur, lacus magna rhoncus odio, pharetra condimentum vel scelerisque dui.
"""
#: Filler: verbs and what to write where (product), kinds of text that a sentence says it is, what is still to come, other.
FILLER = {
    "en": {
        "pattern": "{0} {1} here.",
        "verbs": "Write; Type; Enter; Insert; Add; Put; Paste; Click to add; Please write; Start typing",
        "what": "your text; a description; the summary; the show notes; a title; your content; a few words about yourself; a short biography; the details; a caption; some text; a few lines about the show; the introduction; an abstract; your message",
        "kinds": "This is {0} text; {0} text; {0} content; {0} paragraph; Some {0} copy; Here stands {0} text",
        "kind": "placeholder; dummy; sample; filler; example; default; demo; temporary; test",
        "later": "{0} coming soon; {0} to follow; {0} to come; {0} to be added; {0} will be added later; {0} goes here; {0} pending; {0} not written yet; {0} to be confirmed; No {0}; {0} to be announced; {0} missing",
        "fields": "Description; Details; Content; Text; Notes; Summary; Title; Information; Biography; Transcript",
        "other": """Replace this text with your own.; Replace this before publishing.; Do not publish.; Delete this paragraph and start writing.; Edit this text to make it your own.; test; test test test; testing testing one two three; testing 123; asdf asdf jkl; asdfghjkl; qwerty qwertyuiop; blah blah blah; yada yada; foo bar baz; xxx xxx xxx; xxxxx; abc abc abc; abcdefg; aaaa aaaa;
         hello world; The quick brown fox jumps over the lazy dog.; Untitled; n/a; none; tbd; tba; todo; 1234567890; lorem; ...; - - -; This is just a test.; Only here to show the layout.; Nothing to see yet.; Watch this space.""",
    },
    "vi": {
        "pattern": "{0} {1} ở đây.",
        "verbs": "Viết; Nhập; Gõ; Thêm; Điền; Chèn; Dán; Bấm để thêm; Hãy viết; Bắt đầu nhập",
        "what": "văn bản của bạn; mô tả; phần tóm tắt; ghi chú tập; tiêu đề; nội dung của bạn; vài lời về bạn; tiểu sử ngắn; chi tiết; chú thích; đoạn văn; vài dòng về chương trình; lời giới thiệu; lời nhắn của bạn",
        "kinds": "Đây là văn bản {0}; văn bản {0}; nội dung {0}; đoạn văn {0}; chữ {0}",
        "kind": "giữ chỗ; mẫu; giả; thử; ví dụ; mặc định; minh hoạ; tạm thời; thử nghiệm",
        "later": "{0} sẽ có sau; {0} đang cập nhật; {0} sắp có; {0} sẽ được thêm sau; {0} để ở đây; chưa có {0}; {0} chưa được viết; {0} sẽ bổ sung; {0} chờ xác nhận; {0} sẽ thông báo sau",
        "fields": "Mô tả; Chi tiết; Nội dung; Văn bản; Ghi chú; Tóm tắt; Tiêu đề; Thông tin; Tiểu sử; Bản chép lời",
        "other": """Thay đoạn này bằng nội dung của bạn.; Thay trước khi xuất bản.; Không đăng bài này.; Xoá đoạn này rồi bắt đầu viết.; Sửa đoạn này theo ý bạn.; thử thử thử; thử nghiệm một hai ba; kiểm tra kiểm tra; chạy thử 123; test test; asdf asdf; qwerty; abc abc abc; xxx xxx; aaaa aaaa; bla bla bla; chưa đặt tên; không có mô tả; đang chờ nội dung; Chỉ để xem bố cục.; Chưa có gì ở đây.""",
    },
    "es": {
        "pattern": "{0} {1} aquí.",
        "verbs": "Escribe; Teclea; Introduce; Inserta; Añade; Pon; Pega; Pulsa para añadir; Redacta; Empieza a escribir",
        "what": "tu texto; una descripción; el resumen; las notas del programa; un título; tu contenido; unas palabras sobre ti; una breve biografía; los detalles; un pie de foto; algo de texto; unas líneas sobre el programa; la introducción; tu mensaje",
        "kinds": "Este es un texto {0}; texto {0}; contenido {0}; párrafo {0}; unas frases {0}",
        "kind": "de relleno; de prueba; de muestra; de ejemplo; simulado; provisional; por defecto; temporal; ficticio",
        "later": "{0} próximamente; {0} por añadir; {0} por venir; {0} pendiente; {0} se añadirá más tarde; {0} va aquí; {0} sin redactar; {0} por confirmar; sin {0}; {0} por anunciar",
        "fields": "Descripción; Detalles; Contenido; Texto; Notas; Resumen; Título; Información; Biografía; Transcripción",
        "other": """Sustituye este texto por el tuyo.; Cambia esto antes de publicar.; No publicar.; Borra este párrafo y empieza a escribir.; Edita este texto a tu gusto.; prueba prueba prueba; probando uno dos tres; prueba 123; test test; asdf asdf; qwerty; abc abc abc; xxx xxx; aaaa aaaa; bla bla bla; sin título; sin descripción; El veloz murciélago hindú comía feliz cardillo y kiwi.; Solo para ver la maqueta.; Aquí todavía no hay nada.""",
    },
    "ja": {
        "pattern": "{0}{1}。",
        "verbs": "ここに本文を; ここに説明を; ここに文章を; ここに概要を; こちらに番組の紹介を; ここにタイトルを; ここに内容を; この欄に自己紹介を; ここにメッセージを; こちらに詳細を; ここにあらすじを",
        "what": "入力してください; 書いてください; 記入してください; 入れてください; 入ります; 挿入してください; 追加してください; 貼り付けてください; 記載予定です; 追記します",
        "kinds": "これは{0}です; {0}; {0}{0}; {0}が入ります; {0}につき差し替え予定",
        "kind": "ダミーテキスト; サンプルテキスト; 仮のテキスト; テスト文章; 見本の文章; 例文; ダミー; サンプル; 仮文",
        "later": "{0}は準備中です; {0}は近日公開; {0}は後日追加します; {0}は未定です; {0}なし; {0}は追ってお知らせします; {0}は作成中です; {0}は未入力です; {0}がここに入ります; {0}は後で差し替えます",
        "fields": "説明; 詳細; 内容; 本文; メモ; 概要; タイトル; 情報; プロフィール; 文字起こし",
        "other": """この文章を差し替えてください。; 公開前に書き換えてください。; 公開しないでください。; この段落を消して書き始めてください。; テストテストテスト; テスト投稿です。; てすとてすと; あああああ; ああああああああ; いろはにほへとちりぬるを; あいうえお; ほげほげ; ほげふが; 文字文字文字文字; テキストテキストテキスト; 無題; 説明なし; レイアウト確認用です。; まだ何もありません。; 仮です。; xxx; test test; asdf""",
    },
}

#: Real text about such things: who, does what with it, what it is, and how the sentence ends.
MENTION = {
    "en": (
        "We; She; He; They; My guest; Our producer; The engineer; A listener; The two friends; Her brother",
        "talked about; remembered; laughed about; told the story of; explained; described; complained about; wrote a song about; still dreams of; made a career out of",
        """the night the website went down; the day every page showed an error; an error message that became famous; the drawing on the error page; a wedding invitation with dummy text on it; the lorem ipsum that nobody had replaced; a page that asks for JavaScript; why so many sites want scripts enabled; a server that crashed
         on the opening day; how a missing page cost them a customer; the number 404 on a hotel door; a placeholder name that stayed in the book; what happens when a session expires; the template that greeted everyone by the wrong name; the week without internet; the first web server in town""",
        "and what came of it; over a cup of tea; for almost an hour; and how it was mended in the end; as if it were a love story; with a lot of patience; before the music starts; to explain the job to children",
        "{0} {1} {2} {3}.",
    ),
    "vi": (
        "Chúng mình; Cô ấy; Anh ấy; Hai người; Khách mời; Nhà sản xuất; Kỹ sư; Một thính giả; Đôi bạn; Em trai chị",
        "kể về; nhớ lại; cười về; giải thích; mô tả; than phiền về; viết bài hát về; vẫn mơ thấy; bàn về; nói chuyện về",
        """đêm trang web bị sập; ngày trang nào cũng báo lỗi; một thông báo lỗi nổi tiếng; bức vẽ trên trang lỗi; tấm thiệp cưới in chữ giả; đoạn lorem ipsum không ai thay; trang web cứ đòi JavaScript; vì sao nhiều trang bắt bật tập lệnh; máy chủ hỏng đúng ngày khai trương; chuyện mất khách vì một trang không tìm thấy;
         số 404 trên cửa phòng khách sạn; cái tên giữ chỗ còn sót trong sách; chuyện gì xảy ra khi phiên hết hạn; mẫu thư gọi sai tên mọi người; một tuần không có mạng; máy chủ đầu tiên ở thị trấn""",
        "và kết cục của nó; bên tách trà; suốt gần một tiếng; và cách sửa được sau cùng; như một chuyện tình; rất kiên nhẫn; trước khi nhạc vang lên; để trẻ con hiểu công việc",
        "{0} {1} {2} {3}.",
    ),
    "es": (
        "Nosotras; Ella; Él; Los dos; Nuestra invitada; La productora; El ingeniero; Una oyente; Las amigas; Su hermano",
        "hablan de; recuerdan; se ríen de; cuentan la historia de; explican; describen; se quejan de; escribieron una canción sobre; todavía sueñan con; viven de",
        """la noche en que se cayó la web; el día en que todas las páginas daban error; un mensaje de error que se hizo famoso; el dibujo de la página de error; una invitación de boda con texto de relleno; el lorem ipsum que nadie cambió; una página que pide JavaScript; por qué tantas webs piden activar scripts; un servidor que falló el día del estreno;
         cómo una página perdida les costó un cliente; el número 404 en la puerta del hotel; un nombre provisional que se quedó en el libro; lo que pasa cuando caduca una sesión; la plantilla que saludaba a todos con otro nombre; la semana sin internet; el primer servidor del pueblo""",
        "y lo que vino después; con una taza de té; durante casi una hora; y cómo se arregló al final; como si fuera una historia de amor; con mucha paciencia; antes de la música; para que lo entiendan los niños",
        "{0} {1} {2} {3}.",
    ),
    "ja": (
        "私たちは; 彼女は; 彼は; 二人は; ゲストは; プロデューサーは; 技術者は; リスナーの一人は; 友人同士で; 弟さんは",
        "についてゆっくり; について笑いながら; について真剣に; について思い出しながら; についてお茶を飲みつつ; について一時間近く; について子どもにもわかるように; について懐かしそうに",
        """サイトが落ちた夜; どのページもエラーになった日; 有名になったエラーメッセージ; エラー画面に描かれた絵; ダミーテキストのまま刷られた招待状; 誰も直さなかった仮の文章; JavaScriptを求めるページ; スクリプトの許可を求めるサイトが多い理由; 初日に止まったサーバー; ページが見つからずに客を逃した話; ホテルの404号室; 本に残ってしまった仮の名前; セッションが切れる仕組み; 名前を間違えて呼ぶひな形の手紙; インターネットのない一週間; 町で最初のサーバー""",
        "話しました; 語ってくれました; 説明しました; 振り返ります; 歌にしました; 教えてくれます; 話し合いました; 聞かせてくれました",
        "{0}{2}{1}{3}。",
    ),
}

#: Sentences around a template field (F): unfilled, and quoted or used for something else.
SLOTS = {
    "en": """Welcome to F.; Welcome back to F with F.; Hello F,; Hi F!; Dear F,; Thank you, F.; My guest today is F.; Today's guest: F.; This episode is sponsored by F.; Supported by F.; Recorded on F.; Published: F.; Date: F.; Length: F; Duration: F minutes.; Title: F; Host: F; Guest: F; Hosted by F and F.; In this episode F talks with F about F.; In episode F we meet F.; Follow F on F.; Visit F.; Write to F.;
     Find out more at F.; Use the code F for a discount.; Season F, episode F.; F joins us from F.; About F; Copyright F F.; Subscribe to F.; Listen on F.; Join F on F at F.; Music by F.; Produced by F for F.; This is F, and you are listening to F.; Next week: F.; Chapter F: F; See you on F!; Your order F has been sent to F.; Best wishes, F; Links: F; Call us on F.; F""",
    "vi": """Chào mừng đến với F.; Chào mừng bạn quay lại F cùng F.; Xin chào F,; Chào F!; Thân gửi F,; Cảm ơn F.; Khách mời hôm nay là F.; Khách mời: F.; Tập này do F tài trợ.; Được hỗ trợ bởi F.; Thu âm ngày F.; Đăng ngày: F.; Ngày: F.; Độ dài: F; Thời lượng: F phút.; Tiêu đề: F; Dẫn chương trình: F; Trong tập này F trò chuyện với F về F.; Trong tập F chúng ta gặp F.; Theo dõi F trên F.; Ghé thăm F.; Viết thư cho F.;
     Xem thêm tại F.; Dùng mã F để được giảm giá.; Mùa F, tập F.; F đến từ F.; Về F; Bản quyền F F.; Đăng ký F.; Nghe trên F.; Nhạc: F.; Sản xuất: F.; Tuần tới: F.; Chương F: F; Hẹn gặp lại vào F!; Trân trọng, F; Liên kết: F; Gọi cho chúng tôi theo số F.; F""",
    "es": """Te damos la bienvenida a F.; De vuelta en F con F.; Hola, F:; ¡Hola F!; Estimada F:; Gracias, F.; Hoy nos visita F.; Persona invitada: F.; Este episodio está patrocinado por F.; Con el apoyo de F.; Grabado el F.; Publicado: F.; Fecha: F.; Longitud: F; Duración: F minutos.; Título: F; Presenta: F; En este episodio F conversa con F sobre F.; En el episodio F conocemos a F.; Sigue a F en F.; Visita F.; Escribe a F.;
     Más información en F.; Usa el código F para un descuento.; Temporada F, episodio F.; F nos acompaña desde F.; Sobre F; Copyright F F.; Suscríbete a F.; Escúchalo en F.; Música: F.; Producido por F.; La próxima semana: F.; Capítulo F: F; ¡Hasta el F!; Un saludo, F; Enlaces: F; Llámanos al F.; F""",
    "ja": """Fへようこそ。; FとFがお送りします。; F様; こんにちは、Fさん。; ありがとうございます、Fさん。; 本日のゲストはFさんです。; ゲスト：F; この回はFの提供でお送りします。; 協賛：F; 収録日：F; 公開日：F; 日付：F; 長さ：F; 再生時間はF分です。; タイトル：F; 司会：F; 今回はFさんとFさんがFについて話します。; 第F回ではFさんを迎えます。; Fをフォローしてください。; 詳しくはFまで。; Fまでお便りください。;
     クーポンコードFで割引になります。; シーズンF 第F話; Fさんについて; 著作権 F F; Fに登録してください。; Fで聴けます。; 音楽：F; 制作：F; 来週はFです。; 第F章：F; それではFにお会いしましょう。; F より; リンク：F; お電話はFまで。; F""",
}
QUOTES = {
    "en": """The letter opened with F, which made us smile.; It literally said F.; It really read "F".; She typed F and waited.; He wrote F on the board.; Someone had printed F on the cake.; The template contains F, and the program puts the name there.; The tag F stands for a name.; The variable F holds the number of guests.; We saw F instead of a name.; The newsletter went out with F in it, and everybody laughed.; Signs like F are called placeholders.;
     People who write F by hand are patient.; A field called F; The syntax F looks strange at first.; The software replaces F with the name of the reader.; F is a placeholder.; What do the brackets in F mean?; Someone forgot to fill in F, she says.; A mail addressed to F made us laugh.; In mathematics F is a set.; The set F has two elements.; In the programming lesson we learn what F does.; Write F where the name should be, he explains.; He keeps a letter that begins "Dear F".; The joke was that his badge said F.; The code F is explained in the manual.; She shows how F turns into a name.; "F" was the title by accident.; Nobody noticed the F on the poster.""",
    "vi": """Lá thư mở đầu bằng F khiến cả nhà bật cười.; Trên đó ghi đúng chữ F.; Nó ghi "F" thật.; Cô gõ F rồi ngồi chờ.; Thầy viết F lên bảng.; Ai đó in F lên bánh kem.; Mẫu có chứa F và phần mềm sẽ điền tên vào.; Thẻ F đại diện cho tên.; Biến F giữ số khách.; Chúng tôi thấy F thay vì tên người.; Bản tin gửi đi còn nguyên F và ai cũng cười.; Ký hiệu như F gọi là chỗ giữ sẵn.;
     Trường tên là F; Cú pháp F thoạt đầu trông lạ.; Phần mềm thay F bằng tên người đọc.; F là ký hiệu giữ chỗ.; Dấu ngoặc trong F nghĩa là gì?; Ai đó quên điền F, chị kể.; Thư đề tên F làm chúng tôi cười.; Trong toán học F là một tập hợp.; Tập hợp F có hai phần tử.; Trong bài lập trình ta học F làm gì.; Anh vẫn giữ lá thư bắt đầu bằng "Kính gửi F".; Chuyện buồn cười là thẻ tên ghi F.; Mã F được giải thích trong sách.; Không ai để ý chữ F trên tấm áp phích.""",
    "es": """La carta empezaba por F y nos hizo sonreír.; Ponía literalmente F.; De verdad decía «F».; Tecleó F y esperó.; Escribió F en la pizarra.; Alguien imprimió F en la tarta.; La plantilla contiene F y el programa pone ahí el nombre.; La etiqueta F representa un nombre.; La variable F guarda el número de invitados.; Vimos F en lugar de un nombre.; El boletín salió con F y todos se rieron.; Los signos como F se llaman marcadores.;
     Un campo llamado F; La sintaxis F parece rara al principio.; El programa sustituye F por el nombre de quien lee.; F es un marcador.; ¿Qué significan las llaves de F?; Alguien olvidó rellenar F, dice ella.; Un correo dirigido a F nos hizo reír.; En matemáticas F es un conjunto.; El conjunto F tiene dos elementos.; En la lección de programación aprendemos qué hace F.; Guarda una carta que empieza con «Estimado F».; Lo gracioso era que su tarjeta decía F.; El código F se explica en el manual.; Nadie se fijó en el F del cartel.""",
    "ja": """手紙がFで始まっていて、みんな笑いました。; 本当にFと書いてありました。; 「F」とそのまま印刷されていました。; 彼女はFと入力して待ちました。; 先生は黒板にFと書きました。; ケーキにFと書かれていました。; ひな形にはFが含まれ、ソフトが名前を入れます。; タグFは名前を表します。; 変数Fには人数が入ります。; 名前の代わりにFと表示されました。; Fのまま送られたメールが話題になりました。; Fのような記号はプレースホルダーと呼ばれます。;
     Fという項目; Fという書き方は最初は奇妙に見えます。; ソフトがFを読者の名前に置き換えます。; Fの括弧は何を意味するのでしょう。; 誰かがFを埋め忘れたそうです。; F宛てのメールに笑いました。; 数学ではFは集合です。; 集合Fには要素が二つあります。; プログラミングの回でFの役割を学びます。; 「F様」で始まる手紙を今も持っています。; 名札にFと書かれていたのが笑い話です。; 記号Fの意味は説明書にあります。; ポスターのFに誰も気づきませんでした。""",
}


def notices(x: str) -> list[str]:
    """Sentences of error pages, of notices on scripts and of a page's furniture."""
    n = NOTICE[x]
    things, faults, remedies = _parts(n["things"]), _parts(n["faults"]), _parts(n["remedies"])
    out = [n["pattern"][(i + k) % len(n["pattern"])].format(t, f) for i, t in enumerate(things) for k, f in enumerate(faults)]
    out += [p + (". " if x != "ja" else "。") + remedies[k % len(remedies)] for k, p in enumerate(_parts(n["phrases"]) * 8)]
    status = _parts(STATUS)
    out += [f(s) for s in status for f in (str, "HTTP {}".format, "Error {}".format)]
    blank = "" if x == "ja" else " "
    out += [blank.join(p) + ("。" if x == "ja" else ".") for p in product(_parts(n["do"]), _parts(n["scripts"]), _parts(n["ends"]))]
    out += [s + ("。" if x == "ja" else ".") for s in _parts(n["statements"]) * 12]
    furniture = _parts(n["furniture"])
    return out + [sign.join(furniture[(k * step) % len(furniture)] for k in range(len(furniture))) for step in (1, 5, 7) for sign in (" | ", " > ", " · ", " ")]


def filler(x: str) -> list[str]:
    f = FILLER[x]
    out = [f["pattern"].format(*p) for p in product(_parts(f["verbs"]), _parts(f["what"]))]
    out += [k.format(v) + "." for k, v in product(_parts(f["kinds"]), _parts(f["kind"]))] * 4
    out += [k.format(v) + "." for k, v in product(_parts(f["later"]), _parts(f["fields"]))] * 2
    return out + _parts(f["other"]) * 8


def mentions(x: str) -> list[str]:
    *parts, pattern = MENTION[x]
    who, does, what, end = map(_parts, parts)
    return [pattern.format(who[(i + j) % len(who)], d, w, end[(2 * i + j) % len(end)]) for i, w in enumerate(what) for j, d in enumerate(does)]


#: Template languages and habits: %s stands for the name of a field.
SYNTAX = """{{%s}}; {{ %s }}; {{{%s}}}; {%s}; {%% %s %%}; ${%s}; ${ %s }; #{%s}; %%{%s}; @{%s}; {$%s}; {!%s}; {{#%s}}; {{/%s}}; <%%= %s %%>; <%% %s %%>; <?= %s ?>; <<%s>>; «%s»; [[%s]]; [%s]; [%%%s%%]; [$%s]; <%s>; &lt;%s&gt;; %%%s%%; %%%%%s%%%%; %%(%s)s; $%s$; @%s@; @@%s@@;
 ##%s##; __%s__; *|%s|*; ***%s***; ||%s||; ~%s~; :%s:; (((%s))); ［%s］; 【%s】; （%s）; ＜%s＞; ｛%s｝; 〔%s〕; (%s)"""
#: Forms that are a field by themselves.
BARE = """XX/XX/XXXX; xx/xx/xxxx; XX.XX.XXXX; XXXX-XX-XX; DD/MM/YYYY; YYYY-MM-DD; dd/mm/yyyy; hh:mm; HH:MM:SS; XX:XX; XXX; XXXX; xxxxx; XXX-XXX-XXXX; ____; ________; ______ ______; __/__/____; ……………; ........; 〇〇; 〇〇〇; ○○; ○○○; ◯◯; ●●; △△; ××××; ＿＿＿; ＸＸ; TBD; TBA; TBC; TODO; FIXME; TKTK; %s; %d; {0}; {1}; {}; $1"""
#: Words of field names by language: what is asked for, of whom or what, and what to do.
NAMES = {
    "en": ("name; full name; first name; last name; title; date; time; link; url; number; topic; email; description; summary; bio; code; city; company; address; phone; image; text; quote; duration; length; price; year; month; day; content; subject; handle; listener; sponsor; guest; host; show; episode; season; author; recipient; brand; product; user; customer; field; value; placeholder", "guest; host; show; episode; sponsor; your; podcast; listener; speaker; user; author; contact; company; event; season; series", "insert; enter; add; fill in; your; put; type; choose; select; replace; to be filled in; to be added; to be confirmed; goes here; here"),
    "vi": ("tên; họ tên; họ và tên; tiêu đề; ngày; giờ; liên kết; đường dẫn; số; chủ đề; email; mô tả; tóm tắt; tiểu sử; mã; thành phố; công ty; địa chỉ; điện thoại; hình ảnh; nội dung; thời lượng; giá; năm; tháng; người nghe; nhà tài trợ; khách mời; người dẫn; chương trình; tập; mùa; tác giả; người nhận; thương hiệu; sản phẩm", "khách mời; người dẫn; chương trình; tập; nhà tài trợ; của bạn; người nghe; tác giả; sự kiện; mùa", "chèn; nhập; thêm; điền; ghi; đặt; chọn; thay; sẽ bổ sung; điền sau; ở đây; vào đây"),
    "es": ("nombre; nombre completo; apellido; título; fecha; hora; enlace; url; número; tema; correo; descripción; resumen; biografía; código; ciudad; empresa; dirección; teléfono; imagen; texto; cita; duración; precio; año; mes; contenido; asunto; oyente; patrocinador; invitado; invitada; presentador; programa; episodio; temporada; autora; destinatario; marca; producto", "invitado; presentadora; programa; episodio; patrocinador; tu; oyente; autor; evento; temporada", "insertar; inserta; introduce; añadir; añade; rellenar; escribir; poner; elegir; sustituir; por rellenar; por confirmar; aquí"),
    "ja": ("名前; お名前; 氏名; タイトル; 題名; 日付; 日時; 時間; リンク; 番号; テーマ; メールアドレス; 説明; 概要; 紹介文; コード; 都市; 会社名; 住所; 電話番号; 画像; 本文; 内容; 長さ; 価格; 年; 月; リスナー名; スポンサー名; ゲスト名; 司会者名; 番組名; エピソード名; シーズン; 著者名; 宛名; 商品名", "ゲストの; 司会の; 番組の; エピソードの; スポンサーの; あなたの; リスナーの; 著者の", "を入力; を挿入; を記入; を入れる; を追加; をここに; を選択; 未定; 要確認; が入ります; をここに入力"),
}
#: Names of HTML elements.
HTML = "a abbr address article aside audio b blockquote body br button caption cite code dd del details div dl dt em embed figcaption figure font footer form h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins label li link main mark meta nav noscript ol option p pre rp rt ruby script section select small source span strike strong style sub summary sup svg table tbody td textarea tfoot th thead title tr track tt u ul var video".split()
#: Bracketed matter that is no field: stage directions, asides, headings, what a transcript, a player or a listing puts there.
ASIDES = {
    "en": """laughs; laughter; laughing; music; music playing; applause; pause; silence; inaudible; crosstalk; sighs; coughs; singing; clears throat; phone rings; door closes; bell; both; together; whispering; sic; part 1; part two; live; live from Berlin; remastered; explicit; bonus; rerun; trailer; ad; sponsored; edit; update; spoiler; rebroadcast; minutes; about ten minutes; 45 min; 2019; 2021-2023; see above; see below; see chapter 3; not shown;
     for example; that is; of course; at least; or so; and more; among others; again; as always; thanks to our listeners; who moved there in spring; no relation; her word, not mine; in English; with subtitles; free of charge; first half; second half; if you like; I think; we hope; her mother's recipe; and yes, it rained; about the river; a small town in the north; in those days; he was nine then; it was winter; you know the one; not the other way round""",
    "vi": """cười; tiếng cười; nhạc; nhạc nền; vỗ tay; im lặng; không nghe rõ; nói chen; thở dài; ho; hát; hắng giọng; chuông; cả hai; thì thầm; phần 1; phần hai; trực tiếp; phát lại; bản đầy đủ; quảng cáo; cập nhật; phút; khoảng mười phút; năm 2019; xem ở trên; xem bên dưới; ví dụ; tức là; tất nhiên; ít nhất; hoặc hơn; và nhiều nữa; như mọi khi; cảm ơn các bạn; hồi ấy; lúc đó chín tuổi; mùa đông năm ấy; nhà ở gần sông;
     theo lời mẹ kể; nếu bạn thích; mình nghĩ vậy; miễn phí; có phụ đề; nửa đầu; nửa sau; một thị trấn nhỏ; không phải ngược lại; chuyển về đó từ mùa xuân; công thức của bà""",
    "es": """risas; ríe; música; aplausos; pausa; silencio; inaudible; hablan a la vez; suspira; tos; canta; carraspea; timbre; los dos; susurros; parte 1; segunda parte; en directo; reposición; versión completa; anuncio; actualizado; minutos; unos diez minutos; 2019; ver arriba; véase abajo; por ejemplo; es decir; claro; al menos; o así; y más; como siempre; gracias a quienes nos escuchan; en aquella época; tenía nueve años; era invierno;
     vivía junto al río; la receta de su madre; si te apetece; creo; esperamos; gratis; con subtítulos; primera mitad; segunda mitad; un pueblo del norte; y no al revés; que se mudó en primavera""",
    "ja": """笑; 笑い; 拍手; 音楽; BGM; 沈黙; 聞き取れず; 同時に; ため息; 咳; 歌; 咳払い; 鐘の音; 二人; ささやき; 前編; 後編; 生放送; 再放送; 完全版; 広告; 更新; 約十分; 45分; 2019年; 上を参照; 下記参照; たとえば; つまり; もちろん; 少なくとも; ほか; いつも通り; 当時; 九歳でした; 冬でした; 母のレシピ; よかったら; と思います; 無料; 字幕付き; 前半; 後半; 北の小さな町; お知らせ; 目次; 注意; 重要; 特集; 再掲; 川の近く; 春に引っ越した""",
}
#: Others of those forms: labels and times of transcripts, markup, code, numbers, and what writing uses signs for.
OTHERS = """[00:12:30]; [1:02]; (12:45); [00:00]; [1]; [12]; (1); (2); (a); (b); {1, 2, 3}; {x, y}; {a; b}; (x, y); [0, 1]; (3 + 4); (50%); (5 km); (+84 28 1234 5678); (UTC+7); SPEAKER_00; SPEAKER_01; SPEAKER_12; Speaker_2; HTTP_PROXY; MAX_VALUE; <v Host>; <v Guest>; <v Speaker 1>; [Speaker 1]; [Narrator]; <c.yellow>; <00:00:12.500>; <b>; </b>; <br/>; <br />; <p class="x">; </p>; <a href="https://example.org">; <img src="a.png" alt="b">;
 <!-- note -->; <!DOCTYPE html>; <https://example.org/path>; <mail@example.org>; **bold words**; **note**; *softly*; _softly_; __init__; __main__; ~~gone~~; :smile:; :heart:; :wave:; :-) ; :D; #podcast; @handle; $5; $100; 100%; 20%; -----; =====; *****; ...; %20; &amp;; &nbsp;; (c); (R); (!); (?); (...); [...]; […]; （笑）; （拍手）; 【お知らせ】; 【目次】; 【告知】; <3; XXL; XXI; XX; XIX; XVI; [sic]; (sic); [a]; (DJ); (BBC); (USA); (CEO); (MC); [Intro]; [Outro]; [Verse 1]; [Chorus]"""


def _cases(words: str) -> list[str]:
    """A field's name as template languages write it."""
    parts = words.split()
    camel = parts[0] + "".join(p.capitalize() for p in parts[1:])
    return [words, words.capitalize(), words.title(), words.upper(), "_".join(parts), "_".join(parts).upper(), camel, "-".join(parts)]


def field_names(x: str) -> list[str]:
    things, owners, verbs = map(_parts, NAMES[x])
    if x == "ja":
        return [*things, *(o + t for o in owners for t in things[:12]), *(t + v for t in things for v in verbs)]
    one = [*things, *(f"{t} {o}" if x in ("vi", "es") else f"{o} {t}" for o in owners for t in things[:20])]
    plain = list(chain.from_iterable(_cases(n) for n in one))
    asked = [c for k, n in enumerate(one) for c in (f"{verbs[k % 6]} {n}", f"{verbs[k % 6].capitalize()} {n}", f"{verbs[k % 6]} {n} {verbs[-1]}", f"{verbs[k % 6]} {n}".upper(), f"{n} {verbs[-1]}")]
    dotted = [f"{a}.{b}" for a, b in zip(("user", "guest", "item", "show", "episode", "data", "contact", "meta") * 8, ("name", "firstName", "title", "email", "date", "company", "id", "url", "first_name") * 7, strict=False)] if x == "en" else []
    goes = [f"{'_'.join(n.split()).upper()}_{e}" for n in things[:20] for e in ("GOES_HERE", "HERE", "PLACEHOLDER")] if x == "en" else []
    return plain + asked + dotted + goes + [v for v in verbs if " " in v] * 40


def fields(x: str) -> list[str]:
    """Template fields: each name in some of the ways to write one, and, in capitals with underscores, by itself."""
    syntax, names = [s.strip() for s in SYNTAX.replace("\n", "").split("; ")], field_names(x)
    out = [syntax[(7 * k + j * 11) % len(syntax)] % n for k, n in enumerate(names) for j in range(6)]
    # signs that have other uses, too, are as frequent here as in asides(), so that what they hold decides
    out += [s % n for n in names for s in ("[%s]", "<%s>", "【%s】", "［%s］")] + [s % n for n in names[::3] for s in ("(%s)", "（%s）")]
    return out + [n for n in names if "_" in n and n == n.upper()] + _parts(BARE) * 10


def asides(x: str) -> list[str]:
    """What stands in such signs and is no field."""
    words = list(chain.from_iterable((w, w.capitalize()) for w in _parts(ASIDES[x])))
    forms = ("[%s]", "(%s)", "(%s)", "（%s）", "【%s】", "［%s］", "<i>%s</i>", "*%s*", "**%s**", "[%s]", "_%s_")
    out = [f % w for w in words for f in forms]
    out += [t for h in HTML for t in (f"<{h}>", f"</{h}>", f'<{h} class="a">', f"<{h}/>")]
    return out + _parts(OTHERS) * 4


#: Plain prose, so that a language's commonest words are known even where the corpus has little of it.
PROSE = {
    "en": """When I was young my father took me to the market every Saturday, and we came home with apples, bread and a story about somebody we had met on the way. People often ask me whether I would do it all again, and I always say that I would, only slower. There was a long table under the trees where the neighbours used to eat together when the work was done. She had never seen the sea before, so they drove all night and arrived just as the sun came up.
     Most of what he knows about wood he learned from an old man who hardly spoke. It takes about three weeks to learn the first song and the rest of your life to play it well. In the end nobody could remember who had started the quarrel or what it had been about. They opened a small shop, sold it after two years, and have been travelling with their children ever since. What surprised us most was how quiet the city becomes after a heavy snowfall. I think that is what friendship means: you can be silent with each other for an hour and still feel that you have talked.""",
    "vi": """Hồi nhỏ, cứ sáng thứ bảy ba lại dắt tôi ra chợ, lúc về tay xách táo, bánh mì và một câu chuyện về ai đó gặp dọc đường. Nhiều người hỏi tôi có muốn làm lại từ đầu không, tôi luôn bảo có, chỉ là chậm hơn. Dưới hàng cây có chiếc bàn dài, nơi hàng xóm cùng ăn với nhau sau giờ làm. Cô chưa từng thấy biển nên họ lái xe suốt đêm và đến nơi đúng lúc mặt trời mọc. Hầu hết những gì ông biết về gỗ là học từ một người thợ già rất ít nói.
     Phải mất chừng ba tuần để thuộc bài hát đầu tiên và cả đời để hát cho hay. Rốt cuộc chẳng ai nhớ ai là người gây chuyện trước và vì sao lại cãi nhau. Họ mở một tiệm nhỏ, hai năm sau thì bán lại rồi cùng các con đi khắp nơi cho đến bây giờ. Điều làm chúng tôi ngạc nhiên nhất là thành phố yên lặng đến thế sau một trận mưa lớn. Tôi nghĩ tình bạn là vậy, có thể ngồi im bên nhau cả tiếng mà vẫn thấy như đã nói rất nhiều.""",
    "es": """Cuando era niña, mi padre me llevaba al mercado todos los sábados, y volvíamos a casa con manzanas, pan y alguna historia de la gente que habíamos encontrado por el camino. Muchas veces me preguntan si lo haría todo otra vez, y siempre digo que sí, pero más despacio. Debajo de los árboles había una mesa larga donde los vecinos comían juntos cuando terminaba el trabajo. Ella nunca había visto el mar, así que condujeron toda la noche y llegaron justo cuando salía el sol.
     Casi todo lo que sabe de la madera lo aprendió de un viejo que apenas hablaba. Hacen falta unas tres semanas para tocar la primera canción y el resto de la vida para tocarla bien. Al final nadie se acordaba de quién había empezado la pelea ni de por qué. Abrieron una tienda pequeña, la vendieron a los dos años y desde entonces viajan con sus hijos. Lo que más nos sorprendió fue lo tranquila que se queda la ciudad después de una gran nevada. Creo que la amistad es eso: poder callar una hora al lado de alguien y sentir que se ha dicho mucho. Le gustaba que la gente le contara cómo era su pueblo y qué cosas echaba de menos.""",
    "ja": """子どものころ、土曜日になると父は私を市場に連れて行き、帰りにはりんごとパンと、道で会った誰かの話を持ち帰りました。もう一度やりたいかとよく聞かれますが、私はいつも、もう少しゆっくりならと答えます。木の下に長いテーブルがあって、仕事が終わると近所の人たちが一緒に食事をしたものです。彼女は海を見たことがなかったので、一晩中車を走らせ、ちょうど日が昇るころに着きました。
     木について彼が知っていることのほとんどは、無口な老人から教わったものです。最初の曲を覚えるのに三週間、上手に弾くには一生かかります。結局、誰がけんかを始めたのか、何が原因だったのか、誰も思い出せませんでした。二人は小さな店を開き、二年で手放して、それからずっと子どもたちと旅をしています。一番驚いたのは、大雪のあとの町がとても静かなことでした。友情とは、一時間黙っていても、たくさん話したような気がすることだと思います。""",
}


def prose(x: str) -> list[str]:
    """What plain text has, and text that mentions residue: of each about as much."""
    plain = " ".join(PROSE[x].split())
    return mentions(x) + [plain] * max(1, sum(map(len, mentions(x))) // len(plain))
